"""Inserts into a catalog that may be run again (K6, P5).

A table of a catalog cannot replace the rows of an earlier batch, so a ledger
beside it says which rows are in: one entry per row, by source, batch and the
row's place in the log. A batch is inserted in four steps:

1. its typed rows are staged with their places in the shared folder;
2. an entry says that the batch has begun;
3. the staged rows that have no entry yet are inserted;
4. their places become entries.

A batch that is run again inserts what is missing, which is nothing once it was
complete. If it stopped between 3 and 4, or in 3, there is a beginning without
places. Then the rows of the table are counted, and compared with the entries
of the ledger and what the table held before the ledger knew it: all are in and
only the entries are missing, or none is in and all are inserted. Should a
database have kept a part of them, nothing is inserted and an error says so.

One writer per table at a time, whose rows come through the ledger. Entries of
a batch are read by source and batch, so what a batch costs does not grow with
the ledger; entries of batches that cannot be run again may be deleted.
"""

from __future__ import annotations

import threading
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from rowlake import workspace
from rowlake.functions.naming import quoted
from rowlake.metrics import observation, taken
from rowlake.sources import files

LEDGER = "rowlake_ledger"
FIELDS = (
    "entry string, source string, batch_id bigint, table_name string, log_partition int, log_offset bigint, row_pos int, rows bigint"
)
#: Entries: what a table held when the ledger first saw it, the beginning of a batch, and a row that is in.
BASE, BEGUN, ROW = "base", "begun", "row"
#: The place of a row in its log, under names that no table has.
PLACE = {"partition": "log_partition", "offset": "log_offset", "pos": "row_pos"}
_AT = [f"_rowlake_{name}" for name in PLACE.values()]


class PartlyInserted(RuntimeError):
    """A batch of which a table holds a part, so that neither inserting nor leaving it is right."""


class Ledger:
    """What the tables of one schema of a catalog hold, by batch."""

    def __init__(self, db, schema: str, name: str = LEDGER):
        self.db, self.schema, self.name = db, schema, name
        self.lock = threading.Lock()
        self.made = False

    def entries(self) -> DataFrame:
        with self.lock:
            if not self.made:
                self.db.create(self.schema, self.name, self.db.spark.createDataFrame([], FIELDS))
                self.made = True
        return self.db.spark.table(self.db.name(self.schema, self.name))

    def _of(self, table: str) -> DataFrame:
        return self.entries().where(F.col("table_name") == table)

    def _add(self, entries: DataFrame) -> None:
        # Tables are written from several threads, and appends to one table of files do not mix.
        with self.lock:
            self.db.insert(self.schema, self.name, entries)

    def _mark(self, entry: str, table: str, source: str | None, batch_id: int | None, rows: int | None = None) -> None:
        row = (entry, source, batch_id, table, None, None, None, rows)
        self._add(self.db.spark.createDataFrame([row], FIELDS))

    def _held(self, table: str) -> int:
        return self.db.spark.table(self.db.name(self.schema, table)).count()

    def write(
        self, table: str, rows: DataFrame, columns: list[Column], names: Iterable[str], metrics: dict[str, Column], source: str, batch_id: int
    ) -> dict[str, int]:
        """Insert the rows of a batch that are not in yet; the counts of ``metrics``, and ``rows`` and ``inserted``."""
        spark, names = self.db.spark, list(names)
        own = self._of(table).where((F.col("source") == source) & (F.col("batch_id") == batch_id))
        begun, done = own.agg(F.count_if(F.col("entry") == BEGUN), F.count_if(F.col("entry") == ROW)).first()
        folder = workspace.new_folder(spark, "inserts")
        observed = observation("stage")
        counted = rows.observe(observed, F.count(F.lit(1)).alias("rows"), *[m.alias(n) for n, m in metrics.items()])
        place = [F.col(name).alias(at) for name, at in zip(PLACE, _AT, strict=True)]
        counted.select(*place, *columns).write.parquet(folder)
        try:
            seen = taken(observed)
            if not seen.get("rows"):
                return {**seen, "rows": 0, "inserted": 0}
            staged = spark.read.parquet(folder)
            missing = staged
            if done:
                known = own.where(F.col("entry") == ROW).select(*PLACE.values()).distinct()
                same = [staged[at].eqNullSafe(known[name]) for at, name in zip(_AT, PLACE.values(), strict=True)]
                missing = staged.join(known, same[0] & same[1] & same[2], "left_anti")
            waiting = missing.count() if done else seen["rows"]
            if not waiting:
                return {**seen, "inserted": 0}
            # A place without an entry after others have theirs is in the table: entries follow the rows.
            all_in = bool(done) or (bool(begun) and self._all_in(table, waiting))
            if not begun:
                if not self._of(table).where(F.col("entry") == BASE).head(1):
                    self._mark(BASE, table, None, None, self._held(table))
                self._mark(BEGUN, table, source, batch_id)
            if not all_in:
                self.db.insert(self.schema, table, missing.select(*[quoted(name) for name in names]))
            self._add(
                missing.select(
                    F.lit(ROW).alias("entry"), F.lit(source).alias("source"), F.lit(batch_id).cast("bigint").alias("batch_id"),
                    F.lit(table).alias("table_name"), *[F.col(at).alias(name) for at, name in zip(_AT, PLACE.values(), strict=True)],
                    F.lit(None).cast("bigint").alias("rows"),
                )
            )
            return {**seen, "inserted": 0 if all_in else waiting}
        finally:
            files.delete(spark, folder)

    def _all_in(self, table: str, waiting: int) -> bool:
        """Whether a batch that has begun, and has no entry of a row, is in the table; an error if a part of it is."""
        known, base = self._of(table).agg(F.count_if(F.col("entry") == ROW), F.sum("rows")).first()
        inserted = self._held(table) - known - (base or 0)
        if inserted not in (0, waiting):
            raise PartlyInserted(f"table {table!r} holds {inserted} of the {waiting} rows of a batch that stopped")
        return inserted == waiting
