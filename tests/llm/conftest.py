from __future__ import annotations

import oracle

# Tables that only the SQL of the corpus operators reads.
oracle.TABLES += [t for t in ("documents", "embeddings", "benchmark", "conversations") if t not in oracle.TABLES]
