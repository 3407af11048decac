"""Admitting batches of rows to a table that holds rows already.

A batch has a name. Its rows are checked against the table's contract (columns without NULL, lengths, number ranges,
one row by key) and against the keys that the table holds; rows that pass are admitted and the others go to
``<table>_refused`` with the batch and everything that is wrong with them. Both, and the batch's line in the ledger, are
published by one commit of the table set. So a batch that is sent again adds nothing, whether its first sending ended
well or died at any step, and writers that come at once are put one after the other: the one that finds that another
has committed checks its rows again, against what the table holds by then.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.operators.checks import REFUSED, WRITTEN, write_status
from starmart.operators.joins import join_sliced
from starmart.plans.contracts import Contract
from starmart.sources.manifest import Batch, Conflict, TableSet, TableState

KEY_EXISTS = "key exists"
_STATUS = "_status"


@dataclass(frozen=True)
class Outcome:
    """Rows admitted and refused; ``again`` if the batch had been admitted before, and nothing was done."""

    admitted: int
    refused: int
    again: bool = False


def refused_name(table: str) -> str:
    return f"{table}_refused"


def judge(rows: DataFrame, held: DataFrame | None, contract: Contract, order: str | None = None) -> DataFrame:
    """Rows with ``write_status`` and ``write_error``: the contract's rules, and the keys that are held already.

    Of rows with one key the first by ``order`` (else by content) stands for it. A key that holds a large part of the
    batch is spread over tasks.
    """
    marked = write_status(rows, contract.rules(rows), unique=contract.key, order=order or contract.key[0])
    if held is None:
        return marked
    keys = held.select(*contract.key).withColumn("_held", F.lit(True))
    met = join_sliced(marked, keys, contract.key, "left")
    error = F.nullif(F.concat_ws("; ", "write_error", F.when(F.col("_held"), F.lit(KEY_EXISTS))), F.lit(""))
    return met.select(*rows.columns, F.when(error.isNull(), WRITTEN).otherwise(REFUSED).alias("write_status"), error.alias("write_error"))


def admit_batch(
    tables: TableSet, table: str, rows: DataFrame, batch: str, contract: Contract, order: str | None = None, tries: int = 10
) -> Outcome:
    """Admit the rows of a batch to a table of the set, which is made if it isn't there.

    The rows are read and checked once for each try and written once, good and refused ones by the same job.
    """
    for _ in range(tries):
        state = tables.state()
        held = state.tables.get(table)
        if held and batch in held.batches:
            done = held.batches[batch]
            return Outcome(done.admitted, done.refused, again=True)
        if held and [f.name for f in held.columns()] != rows.columns:
            raise ValueError(f"{table} has the columns {held.columns().names}, the batch {rows.columns}")
        marked = judge(rows, tables.read(table, state) if held else None, contract, order)
        written = marked.withColumn("batch", F.lit(batch)).withColumnRenamed("write_status", _STATUS)
        parts = tables.stage(written, table, by=_STATUS)
        fresh = held or TableState(rows.schema.json())
        aside = state.tables.get(refused_name(table)) or TableState(written.drop(_STATUS).schema.json())
        added = _with_part(fresh, parts.get(str(WRITTEN)))
        refused = _with_part(aside, parts.get(str(REFUSED)))
        counts = Batch(*(tables.rows_of(parts[str(s)]) if str(s) in parts else 0 for s in (WRITTEN, REFUSED)))
        added = replace(added, batches={**fresh.batches, batch: counts})
        try:
            tables.commit(state, {table: added, refused_name(table): refused})
        except Conflict:
            continue
        return Outcome(counts.admitted, counts.refused)
    raise Conflict(f"{table}: others committed before batch {batch} in each of {tries} tries")


def _with_part(held: TableState, part: str | None) -> TableState:
    return replace(held, parts=(*held.parts, part)) if part else held
