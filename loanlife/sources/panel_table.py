"""The servicing panel stored so that lifecycle queries need no exchange of its rows.

Typed rows lie in a Parquet table that is bucketed by (loan, year) and sorted by
loan, year and period within each bucket, one file a bucket and append.  Windows per
loan-year, the removal of copies and the segments of ``operators.segments`` then run on the
buckets where they are; only segments are shuffled.  A loan with a large share of
all rows lies in as many buckets as it has years.  After a second append rows are dealt
once when read, until ``compact`` has made one of all appends.

The number of buckets is part of the data: it is kept in ``layout`` beside the rows, read when
a table is opened again, and a different number is refused, since
rows placed by one number cannot be found by another.  An append
counts once it stands in ``layout``; files that a broken append left are not read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlife.operators import segments as S
from loanlife.operators.detail import dedupe_panel, drop_adjacent_copies, year_group
from loanlife.operators.master import master_from_events

LAYOUT = "buckets int, ddl string, key string, part string"


class PanelTable:
    """A stored panel below ``path`` (a shared folder); created by its first append, reopened otherwise."""

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None, key: str = "id_loan"):
        self.spark, self.path, self.key, self.names = spark, path, key, {}
        spark.createDataFrame([], LAYOUT).write.mode("append").json(f"{path}/layout")
        kept = self._layout()
        self.buckets = kept[0]["buckets"] if kept else buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        if buckets not in (None, self.buckets) or kept and kept[0]["key"] != key:
            raise ValueError(f"{path} has {self.buckets} buckets by {kept[0]['key']}; it cannot be opened with {buckets} by {key}")

    def _layout(self) -> list:
        return self.spark.read.schema(LAYOUT).json(f"{self.path}/layout").orderBy("part").collect()

    def _table(self, part: str, ddl: str) -> str:
        """A catalogue name of this session for one append's rows."""
        if part not in self.names:
            self.names[part] = f"panel_{uuid.uuid4().hex}"
            self.spark.sql(f"CREATE TABLE {self.names[part]} ({ddl}) USING parquet CLUSTERED BY ({self.key}, {S.SEG}) "
                           f"SORTED BY ({self.key}, {S.SEG}, period) INTO {self.buckets} BUCKETS LOCATION '{self.path}/{part}'")
        return self.names[part]

    def _write(self, dealt: DataFrame, number: int, mode: str, placed: bool = False) -> None:
        rows = dealt if placed else dealt.repartition(self.buckets, self.key, S.SEG)
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
        part = f"rows-{number:06}-{uuid.uuid4().hex}"
        name = self._table(part, ddl)
        (rows.write.format("parquet").mode("append").bucketBy(self.buckets, self.key, S.SEG)
         .sortBy(self.key, S.SEG, "period").option("path", f"{self.path}/{part}").saveAsTable(name))
        (self.spark.createDataFrame([(self.buckets, ddl, self.key, part)], LAYOUT).coalesce(1)
         .write.mode(mode).json(f"{self.path}/layout"))

    def append(self, svcg: DataFrame) -> None:
        """Add typed rows; copies among them are removed.  Rows with their year as ``seg`` that lie dealt by loan and
        ``seg`` over as many tasks as there are buckets are written where they are."""
        kept, placed = self._layout(), S.SEG in svcg.columns
        dealt = drop_adjacent_copies(svcg, self.key, S.SEG) if placed else S.deal(svcg, year_group(), self.key)
        if kept and set(self.dealt().dtypes) != set(dealt.dtypes):
            raise ValueError(f"columns differ from those of {self.path}: {kept[0]['ddl']}")
        self._write(dealt, len(kept), "append", placed)

    def dealt(self) -> DataFrame:
        """All rows without copies, with their year as ``seg``, partitioned by loan and year as they lie."""
        kept = self._layout()
        if not kept:
            raise ValueError(f"nothing has been appended to {self.path}")
        if len(kept) == 1:
            return self.spark.table(self._table(kept[0]["part"], kept[0]["ddl"]))
        # Copies may lie in different appends: read as plain files, dealt anew.
        rows = self.spark.read.schema(kept[0]["ddl"]).parquet(*[f"{self.path}/{r['part']}" for r in kept])
        return dedupe_panel(rows).repartition(self.key, S.SEG)

    def rows(self) -> DataFrame:
        return self.dealt().drop(S.SEG)

    def compact(self) -> None:
        """Rewrite all appends as one, so that reading needs no exchange again."""
        if len(self._layout()) > 1:
            self._write(self.dealt(), 0, "overwrite")

    def master(self, orig: DataFrame) -> DataFrame:
        events = S.finish(S.fold(S.segments(self.dealt(), self.key), self.key), self.key)
        return master_from_events(orig, events, self.key)

    def close(self) -> None:
        """Forget the session's catalogue names; the files stay."""
        for name in self.names.values():
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.names = {}
