"""One query for each operator over the whole of its table, and the same result as DuckDB SQL where SQL can."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm import (
    byte_bpe,
    decontamination,
    exact_dedup,
    html_extraction,
    language_id,
    merkle,
    mixing,
    near_dedup,
    prefix_trie,
    quality,
    token_counts,
    topk,
    toxicity,
)
from starmart.llm.columns import in_class
from starmart.llm.shipping import ship_package
from starmart.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return build(spark, sf_dir)

    QUERIES[build.__name__] = run
    return build


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


@query
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of each pass over their source: doc_id, source, n_words, pass."""
    path = scratch_path(spark, "word-counts")
    docs = read(spark, sf_dir, "documents")
    docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("n_words")).write.parquet(path)
    sizes = spark.read.parquet(path)
    return mixing.plan_mix(sizes, F.col("n_words")).apply(sizes)


def _draw(*parts: str) -> str:
    return f"CAST('0x' || substr(md5(concat_ws('|', {', '.join(parts)})), 1, 8) AS BIGINT)"


ORACLES["op1_mixing"] = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce(CAST(doc_id AS VARCHAR), 'null') AS id, coalesce('=' || source, 'null') AS key,
    len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS n_words
  FROM documents
), s AS (
  SELECT key, CAST(sum(n_words) AS BIGINT) AS t, count(*) AS n FROM d GROUP BY key
), total AS (
  SELECT CAST(sum(t) AS DOUBLE) AS whole, max(t) FILTER (t > 0) / min(t) FILTER (t > 0) AS ratio, count(*) FILTER (t > 0) AS m FROM s
), p AS (
  SELECT key, t / whole AS share FROM s, total WHERE t > 0
), bisection AS (
  SELECT 0 AS i, CAST(0 AS DOUBLE) AS low, CAST(2 AS DOUBLE) AS high
  UNION ALL
  SELECT i + 1, CASE WHEN reached THEN middle ELSE low END, CASE WHEN reached THEN high ELSE middle END
  FROM (
    SELECT b.i, b.low, b.high, (b.low + b.high) / 2 AS middle,
      (SELECT ln(sum(pow(share, (b.low + b.high) / 2)))
         - (b.low + b.high) / 2 * sum(pow(share, (b.low + b.high) / 2) * ln(share)) / sum(pow(share, (b.low + b.high) / 2))
       FROM p) >= (SELECT 0.999 * ln(m) - 1e-9 FROM total) AS reached
    FROM bisection b WHERE b.i < 61
  )
), exponent AS (
  SELECT CASE WHEN m < 2 OR ratio = 1 THEN 1 ELSE greatest(least(1, low), 1 - ln(2) / ln(ratio)) END AS x
  FROM bisection, total WHERE i = 61
), w AS (
  SELECT key, pow(share, x) / sum(pow(share, x)) OVER () AS weight FROM p, exponent
), budget AS (
  SELECT ceil(max(t / weight) * (1 + 1e-12)) AS b FROM w JOIN s USING (key)
), plan AS (
  SELECT key, t, CAST(floor(sqrt(CAST(n - 1 AS DOUBLE))) AS BIGINT) + 1 AS blocks,
    coalesce(CAST(floor(weight * b + 1e-6) AS BIGINT) // t, 1) AS passes,
    coalesce(CAST(floor(weight * b + 1e-6) AS BIGINT) % t, 0) AS left_over
  FROM s LEFT JOIN w USING (key), budget
), dealt AS (
  SELECT d.*, blocks, passes, left_over, {_draw("'block'", "id")} % blocks AS block FROM d JOIN plan USING (key)
), b AS (
  SELECT key, block, passes, left_over, sum(n_words) AS tokens FROM dealt GROUP BY ALL
), ordered AS (
  SELECT *, coalesce(sum(tokens) OVER (PARTITION BY key ORDER BY {_draw("'order'", "key", "block", "passes")}, block
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM b
), edge AS (
  SELECT key, id, room, sum(tokens) OVER (PARTITION BY key ORDER BY {_draw("'order'", "id", "passes")}, id) AS spent
  FROM (
    SELECT dealt.key, dealt.id, dealt.passes, o.left_over - o.before AS room, sum(n_words) AS tokens
    FROM dealt JOIN ordered o ON o.key = dealt.key AND o.block = dealt.block
    WHERE o.before < o.left_over AND o.before + o.tokens > o.left_over GROUP BY ALL
  )
)
SELECT doc_id, source, n_words, CAST(unnest(range(copies)) AS INTEGER) AS pass FROM (
  SELECT d.doc_id, d.source, d.n_words, d.passes
    + CASE WHEN (d.key, d.block) IN (SELECT (key, block) FROM ordered WHERE before < left_over AND before + tokens <= left_over)
        OR (d.key, d.id) IN (SELECT (key, id) FROM edge WHERE spent <= room) THEN 1 ELSE 0 END AS copies
  FROM dealt d
)
"""


@query
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = in_class(F.col("doc_id"), 3, 1)
    found = language_id.identify(language_id.fit(docs, ~held_out))(F.col("text"))
    return docs.select("doc_id", held_out.alias("held_out"), found.alias("found")).select(
        "doc_id", "held_out", F.col("found.lang").alias("lang_pred"), "found.score"
    )


@query
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    bpe = byte_bpe.round_trip(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return docs.select("doc_id", bpe(F.col("text")).alias("bpe")).select(
        "doc_id",
        "bpe.n_tokens",
        F.sha2(F.col("bpe.ids").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("bpe.decoded", 256).alias("decoded_sha256"),
    )


@query
def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.near_duplicates(read(spark, sf_dir, "documents"), words=2)
    return found.select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), "kept"
    )


ORACLES["op4_near_dedup"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(
    string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) < 2 THEN [list_aggregate(ws, 'string_agg', ' ')]
    ELSE list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) END) AS sh
  FROM w WHERE len(ws) > 0
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), often AS (
  SELECT sh, count(*) AS c FROM s GROUP BY sh
), ranked AS (
  SELECT s.doc_id, s.sh, n.n, row_number() OVER (PARTITION BY s.doc_id ORDER BY often.c, s.sh) AS r
  FROM s JOIN often USING (sh) JOIN n USING (doc_id)
), rare AS (
  SELECT doc_id, sh, n FROM ranked WHERE r <= n - ceil(0.8 * n) + 1
), cand AS (
  SELECT DISTINCT a.doc_id AS a, b.doc_id AS b FROM rare a JOIN rare b ON a.sh = b.sh AND a.doc_id < b.doc_id
  WHERE 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
), common AS (
  SELECT a, b, count(*) AS c FROM cand JOIN s sa ON sa.doc_id = a JOIN s sb ON sb.doc_id = b AND sb.sh = sa.sh
  GROUP BY a, b
), link AS (
  SELECT a, b FROM common JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 80 * (na.n + nb.n - c)
), both_ways AS (
  SELECT a, b FROM link UNION SELECT b, a FROM link
), reach AS (
  SELECT a AS doc_id, a AS other FROM both_ways
  UNION
  SELECT r.doc_id, e.b FROM reach r JOIN both_ways e ON r.other = e.a
), least_id AS (
  SELECT doc_id, min(other) AS c FROM reach GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(l.c, d.doc_id) AS component_id,
       coalesce(l.c, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN least_id l USING (doc_id)
"""


@query
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = exact_dedup.deduplicate(docs, exact_dedup.DigestIndex.temporary(spark))
    return found.select(
        F.col("id").alias("doc_id"),
        "keep_id",
        "group_size",
        "kept",
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


ORACLES["op5_exact_dedup"] = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS h
  FROM documents
)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, h AS text_sha256
FROM d WINDOW w AS (PARTITION BY h)
"""


@query
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.count_tokens(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    docs = read(spark, sf_dir, "documents")
    return docs.select("doc_id", counts(F.col("text")).alias("c")).select("doc_id", "c.n_words", "c.n_tokens")


@query
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = in_class(F.col("doc_id"), 5, 0)
    model = quality.fit(docs, read(spark, sf_dir, "labels"), ~held_out)
    return docs.select("doc_id", held_out.alias("held_out"), quality.score(model)("text").alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.3).cast("int")
    )


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = in_class(F.col("doc_id"), 5, 0)
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"), ~held_out)
    return docs.select("doc_id", held_out.alias("held_out"), toxicity.score(model)("text").alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int")
    )


@query
def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = topk.top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


ORACLES["op8_top_k"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CASE WHEN least(len(q.e), len(c.e)) = 0 THEN 0
    ELSE CAST(list_dot_product(q.e::DOUBLE[], c.e::DOUBLE[]) AS BIGINT) END AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""


@query
def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    found = pages.select("page_id", "url", html_extraction.extract()("html").alias("text"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


#: Turns of a conversation that its neighbours may take over, at most.
HEAD = 5


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, key, sizes) of every conversation c, from a turn table: the first h turns of conversation c - c % 100,
    then c's own from the h-th on, with h = crc32(c) % 6."""
    h = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(HEAD + 1)).cast("int")
    turn = F.struct("pos", "id", "size")
    heads = turns.filter(F.col("pos") < HEAD).groupBy(F.col("conv_id").alias("base")).agg(F.sort_array(F.collect_list(turn)).alias("head"))
    own = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.when(F.col("pos") >= h, turn))).alias("tail"))
    own = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % 100)
    joined = own.join(heads, "base", "left")
    head = F.when(F.col("head").isNull(), F.slice("tail", 1, 0)).otherwise(F.slice("head", F.lit(1), h))
    full = F.concat(head, F.col("tail"))
    return joined.select("conv_id", prefix_trie.key_of(full).alias("key"), prefix_trie.sizes_of(full).alias("sizes"))


@query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of the rebuilt conversations, one row per node."""
    turns = prefix_trie.turn_table(read(spark, sf_dir, "conversations"))
    return prefix_trie.trie(rebuilt(turns)).drop("turn_id")


#: CRC-32 (reflected polynomial EDB88320) of the decimal text of an id, unsigned, bit by bit.
def _crc32(id: str) -> str:
    byte = "list_reduce(range(8), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, xor(c, b))"
    text = f"CAST({id} AS VARCHAR)"
    codes = f"list_transform(string_split({text}, ''), lambda x: CAST(ord(x) AS BIGINT))"
    return f"xor(list_reduce({codes}, lambda c, b: {byte}, 4294967295), 4294967295)"


@query
def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document, and the root that a tampered copy folds to."""
    docs = read(spark, sf_dir, "documents")
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")  # no number of characters overflows
    changed = merkle.leaf_of(*[more if c == "n_chars" else F.col(c) for c in fields])
    tampered = F.when(in_class(F.col("doc_id"), 7, 0), changed)
    found = merkle.manifest(docs, fields, carry={"tampered": tampered})
    folded = merkle.fold(F.coalesce("tampered", "leaf"), F.col("path"))
    return found.select(
        F.col("id").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        merkle.digest(merkle.siblings(F.col("path"))).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


_ENCODED = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR) END"


def _leaf(n_chars: str) -> str:
    return f"sha256({' || '.join(_ENCODED.format(c) for c in ('doc_id', 'source', 'lang', n_chars, 'text'))})"


ORACLES["op12_merkle"] = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, lang, {_leaf("n_chars")} AS leaf,
    CASE WHEN {_crc32("doc_id")} % 7 = 0 THEN {_leaf("(n_chars + 1)")} ELSE {_leaf("n_chars")} END AS tampered
  FROM documents
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM d
), tree AS (
  SELECT lang, 0 AS level, list(leaf ORDER BY pos) AS nodes FROM placed GROUP BY lang
  UNION ALL
  SELECT lang, level + 1, list_transform(range(0, len(nodes), 2), lambda i: sha256(nodes[i + 1] || coalesce(nodes[i + 2], '')))
  FROM tree WHERE len(nodes) > 1
), subroots AS (
  SELECT lang, nodes[1] AS subroot, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS pos FROM tree WHERE len(nodes) = 1
), top AS (
  SELECT 0 AS level, list(subroot ORDER BY pos) AS nodes FROM subroots
  UNION ALL
  SELECT level + 1, list_transform(range(0, len(nodes), 2), lambda i: sha256(nodes[i + 1] || coalesce(nodes[i + 2], '')))
  FROM top WHERE len(nodes) > 1
), steps AS (
  SELECT p.doc_id, p.leaf, p.pos, 0 AS part, t.level, p.pos >> t.level AS place, t.nodes
  FROM placed p JOIN tree t ON t.lang IS NOT DISTINCT FROM p.lang WHERE len(t.nodes) > 1
  UNION ALL
  SELECT p.doc_id, p.leaf, p.pos, 1, t.level, s.pos >> t.level, t.nodes
  FROM placed p JOIN subroots s ON s.lang IS NOT DISTINCT FROM p.lang, top t WHERE len(t.nodes) > 1
), sides AS (
  SELECT doc_id, leaf, pos, part, level,
    CASE WHEN place % 2 = 1 THEN nodes[place] ELSE '' END AS l,
    CASE WHEN place % 2 = 0 THEN coalesce(nodes[place + 2], '') ELSE '' END AS r
  FROM steps
), paths AS (
  SELECT doc_id, leaf, pos, string_agg(l || r, '' ORDER BY part, level) AS sibs,
    list({{'l': l, 'r': r, 'x': ''}} ORDER BY part, level) AS path FROM sides GROUP BY ALL
)
SELECT p.doc_id, p.leaf, s.subroot, (SELECT nodes[1] FROM top WHERE len(nodes) = 1) AS root,
  sha256(coalesce(sibs, '')) AS proof_sha256,
  list_reduce(coalesce(path, []), lambda a, x: {{'l': '', 'r': '', 'x': sha256(x.l || a.x || x.r)}}, {{'l': '', 'r': '', 'x': tampered}}).x AS folded_root,
  folded_root = (SELECT nodes[1] FROM top WHERE len(nodes) = 1) AS verified
FROM placed p JOIN subroots s ON s.lang IS NOT DISTINCT FROM p.lang
LEFT JOIN paths q ON q.doc_id IS NOT DISTINCT FROM p.doc_id AND q.leaf = p.leaf AND q.pos = p.pos
"""


ORACLES["op11_prefix_trie"] = f"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
    PARTITION BY conv_id
    ORDER BY turn NULLS FIRST, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS i
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base, {_crc32("conv_id")} % 6 AS h FROM (SELECT DISTINCT conv_id FROM t)
), r AS (
  SELECT c.conv_id, 0 AS part, t.i, t.role, t.text FROM c JOIN t ON t.conv_id = c.base AND t.i <= c.h
  UNION ALL
  SELECT c.conv_id, 1, t.i, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id AND t.i > c.h
), whole AS (
  SELECT c.conv_id, coalesce(list({{'r': role, 't': text}} ORDER BY part, i) FILTER (role IS NOT NULL), []) AS s
  FROM c LEFT JOIN r USING (conv_id) GROUP BY c.conv_id
), member AS (
  SELECT conv_id, len(s) AS n, unnest(range(len(s) + 1)) AS depth, s FROM whole
), node AS (
  SELECT s[1:depth] AS path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    string_agg(CASE WHEN depth = n THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id) AS ends
  FROM member GROUP BY ALL
), child AS (
  SELECT path[1:depth - 1] AS path, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY ALL
), counted AS (
  SELECT node.*, coalesce(n_children, 0) AS n_children,
    CASE WHEN depth > 0 THEN (n_convs - 1) * length(path[depth].t) ELSE 0 END AS saved
  FROM node LEFT JOIN child USING (path)
), up AS (
  SELECT path[1:d] AS path, sum(saved) AS saved, count(*) FILTER (n_children = 0) AS leaves
  FROM (SELECT *, unnest(range(depth + 1)) AS d FROM counted) GROUP BY ALL
)
SELECT c.conv_id, c.depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, up.leaves AS n_leaves,
  CAST(up.saved AS BIGINT) AS saved_tokens, sha256(coalesce(c.ends, '')) AS ends_sha256
FROM counted c JOIN up USING (path) LEFT JOIN node p ON c.depth > 0 AND p.path = c.path[1:c.depth - 1]
"""


@query
def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that are in a window of the benchmark, and the items that they are of."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    windows = decontamination.window_table(read(spark, sf_dir, "benchmark"))
    found = decontamination.find_windows(docs, windows)
    return found.select(
        "doc_id",
        "found.n_words",
        decontamination.n_hit(F.col("found")).alias("n_hit"),
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("found.items", ","), 256).alias("items_sha256"),
        (F.size("found.first") > 0).alias("contaminated"),
    )


_WORDS = r"""list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"""

ORACLES["op13_decontamination"] = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS ws FROM documents
), i AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS} AS ws FROM benchmark
), w AS (
  SELECT DISTINCT item, size, ws[k:k + size - 1] AS win
  FROM (SELECT *, least(len(ws), 10) AS size, unnest(range(1, greatest(len(ws) - 8, 2))) AS k FROM i WHERE len(ws) > 0)
), sizes AS (
  SELECT DISTINCT size FROM w
), place AS (
  SELECT r, size, k, ws[k:k + size - 1] AS win
  FROM (SELECT r, ws, size, unnest(range(1, len(ws) - size + 2)) AS k FROM d, sizes WHERE len(ws) >= size)
), occurs AS (
  SELECT r, k, place.size, item FROM place JOIN w ON w.size = place.size AND w.win = place.win
), hit AS (
  SELECT r, count(*) AS n FROM (SELECT DISTINCT r, unnest(range(k, k + size)) AS word FROM occurs) GROUP BY r
), items AS (
  SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY encode(item)) AS names FROM (SELECT DISTINCT r, item FROM occurs) GROUP BY r
)
SELECT doc_id, len(ws) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, hit.n IS NOT NULL AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN items USING (r)
"""
