"""Keyed tables that grow by runs and are merged on read.

A table is a folder of runs, each written once in hash buckets of the key, and a
numbered manifest that names the runs that count. An append writes its own rows
and nothing else. Where `FANOUT` runs of a level have gathered they are merged into
one of the next, so a row is written again a few times in all, however many
appends there are. A reader that knows which keys it wants reads their buckets only.

A run or manifest that is not finished is never named, so a job that dies leaves
files behind but no rows; one writer at a time is assumed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanloom.operators.keys import latest_per_key
from loanloom.sizing import small_side

BUCKETS = 64
FANOUT = 8
_EXTRA = T.StructType([T.StructField("__seq", T.LongType()), T.StructField("__gone", T.BooleanType())])


@dataclass
class Manifest:
    """What a table consists of: its keys, order, columns, buckets and runs."""

    keys: list[str]
    order: list[str]
    columns: dict
    buckets: int
    version: int = 0
    #: Name, level, and whether the run holds removals, of every run.
    runs: list[dict] = field(default_factory=list)
    #: What the table's owner notes with an append.
    notes: dict = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromJson(self.columns)


class RunTable:
    """One such table. ``order`` says which of a key's rows counts; without it all rows do."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # --- manifest -----------------------------------------------------------

    def _fs(self, path: str):
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark._jsc.hadoopConfiguration()), target

    def manifest(self) -> Manifest | None:
        """The newest manifest; None before the table is created."""
        system, folder = self._fs(f"{self.path}/_manifests")
        if not system.exists(folder):
            return None
        names = [f.getPath().getName() for f in system.listStatus(folder)]
        names = sorted(n for n in names if n.endswith(".json"))
        if not names:
            return None
        stream = system.open(self._fs(f"{self.path}/_manifests/{names[-1]}")[1])
        try:
            return Manifest(**json.loads(bytes(stream.readAllBytes()).decode()))
        finally:
            stream.close()

    def _publish(self, manifest: Manifest) -> None:
        manifest.version += 1
        system, draft = self._fs(f"{self.path}/_manifests/{uuid.uuid4().hex}.draft")
        out = system.create(draft, False)
        out.write(bytearray(json.dumps(manifest.__dict__).encode()))
        out.close()
        if not system.rename(draft, self._fs(f"{self.path}/_manifests/{manifest.version:012d}.json")[1]):
            raise RuntimeError(f"{self.path} was changed by another writer")

    def create(self, schema: T.StructType, keys: Sequence[str], order: Sequence[str] = (), buckets: int = BUCKETS) -> Manifest:
        """The table's manifest, made if there is none; another layout is refused."""
        held = self.manifest()
        if held is None:
            held = Manifest(list(keys), list(order), json.loads(schema.json()), buckets)
            self._publish(held)
        if (held.keys, held.order, held.buckets) != (list(keys), list(order), buckets):
            raise ValueError(f"{self.path} has keys {held.keys}, order {held.order} and {held.buckets} buckets")
        return held

    # --- rows ---------------------------------------------------------------

    def _bucket(self, manifest: Manifest) -> Column:
        return F.pmod(F.xxhash64(*manifest.keys), F.lit(manifest.buckets)).cast("int")

    def _write(self, rows: DataFrame, manifest: Manifest) -> str:
        name = uuid.uuid4().hex
        placed = rows.withColumn("bucket", self._bucket(manifest)).hint("rebalance", "bucket")
        placed.write.partitionBy("bucket").parquet(f"{self.path}/runs/run={name}")
        return name

    def _scan(self, manifest: Manifest, runs: Sequence[dict], wanted: DataFrame | None = None) -> DataFrame:
        schema = T.StructType([*manifest.schema, *_EXTRA])
        # A run without rows leaves a folder without buckets.
        paths = [p for r in runs if self._fs(p := f"{self.path}/runs/run={r['name']}")[0].exists(self._fs(p)[1])]
        if not paths:
            return self.spark.createDataFrame([], schema)
        placed = T.StructType([*schema, T.StructField("run", T.StringType()), T.StructField("bucket", T.IntegerType())])
        found = self.spark.read.schema(placed).option("basePath", f"{self.path}/runs").parquet(*paths)
        if wanted is not None:
            touched = [r[0] for r in wanted.select(self._bucket(manifest)).distinct().collect()]  # at most as many as buckets
            found = found.filter(F.col("bucket").isin(touched))
        return found.drop("run", "bucket")

    def append(self, rows: DataFrame, removed: DataFrame | None = None, notes: dict | None = None) -> None:
        """Add a run. Rows of the keys in ``removed`` that earlier runs hold stop counting; those of this run do."""
        manifest = self.manifest()
        seq = manifest.version + 1
        marked = rows.select(*manifest.schema.names, F.lit(seq).cast("long").alias("__seq"), F.lit(False).alias("__gone"))
        if removed is not None:
            marked = marked.unionByName(self._removals(manifest, removed.select(*manifest.keys).distinct(), F.lit(seq)))
        manifest.runs.append({"name": self._write(marked, manifest), "level": 0, "removals": removed is not None})
        manifest.notes |= notes or {}
        self._publish(manifest)
        self.compact()

    def _merged(self, manifest: Manifest, runs: Sequence[dict], wanted: DataFrame | None = None, keep_removals: bool = False) -> DataFrame:
        """The rows that count among those of some runs."""
        rows = self._scan(manifest, runs, wanted)
        names = [*manifest.schema.names, "__seq", "__gone"]
        removals = None
        if any(r["removals"] for r in runs):
            removals = rows.filter("__gone").groupBy(*manifest.keys).agg(F.max("__seq").alias("__until"))
            right = removals.select(*[F.col(c).alias(f"__{c}") for c in manifest.keys], "__until")
            same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in manifest.keys]
            rows = rows.filter("NOT __gone").join(right, same, "left").filter("__until IS NULL OR __seq >= __until").select(*names)
        if manifest.order:
            rows = self._latest(manifest, runs, wanted, rows if removals is not None else None).select(*names)
        if removals is not None and keep_removals:
            rows = rows.unionByName(self._removals(manifest, removals, F.col("__until")))
        return rows

    def _latest(self, manifest: Manifest, runs: Sequence[dict], wanted: DataFrame | None, live: DataFrame | None) -> DataFrame:
        """Each key's last row. A run has a key once, so the largest run is compared, not aggregated."""
        top = max((r["level"] for r in runs), default=0)
        base = [r for r in runs if r["level"] == top]
        recent = [r for r in runs if r["level"] < top]
        if live is not None or len(base) > 1:
            return latest_per_key(live if live is not None else self._scan(manifest, runs, wanted), manifest.keys, manifest.order)
        old = self._scan(manifest, base, wanted)
        if not recent:
            return old
        new = latest_per_key(self._scan(manifest, recent, wanted), manifest.keys, manifest.order)
        return _newer(old, new, manifest.keys, manifest.order)

    def read(self, wanted: DataFrame | None = None) -> DataFrame:
        """The rows that count: each key's last by ``order``, without removed ones. With ``wanted``, of its keys' buckets."""
        manifest = self.manifest()
        return self._merged(manifest, manifest.runs, wanted).select(*manifest.schema.names)

    def _removals(self, manifest: Manifest, keys: DataFrame, seq: Column) -> DataFrame:
        """Rows that hold nothing but the keys and say since when they are removed."""
        blank = [F.col(f.name) if f.name in manifest.keys else F.lit(None).cast(f.dataType).alias(f.name) for f in manifest.schema]
        return keys.select(*blank, seq.cast("long").alias("__seq"), F.lit(True).alias("__gone"))

    # --- compaction ---------------------------------------------------------

    def compact(self, whole: bool = False) -> None:
        """Merge the runs of each level that has `FANOUT` of them; with ``whole``, all runs into one."""
        manifest = self.manifest()
        level = 0
        while level <= max((r["level"] for r in manifest.runs), default=-1):
            chosen = manifest.runs if whole else [r for r in manifest.runs if r["level"] == level]
            if len(chosen) >= FANOUT or (whole and len(chosen) > 1):
                every = len(chosen) == len(manifest.runs)
                merged = self._merged(manifest, chosen, keep_removals=not every)
                top = max(r["level"] for r in chosen) + 1
                removals = not every and any(r["removals"] for r in chosen)
                run = {"name": self._write(merged, manifest), "level": top, "removals": removals}
                manifest.runs = [r for r in manifest.runs if r not in chosen] + [run]
                self._publish(manifest)
            if whole:
                return
            level += 1


def _newer(old: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """For each key the later of its rows in two tables that have it at most once; ``new`` is the smaller."""
    mark = lambda df, side: df.select(*[F.col(c).alias(f"__{side}_{c}") for c in keys], F.struct(*order).alias(f"__{side}"))
    same = lambda side: [F.col(c).eqNullSafe(F.col(f"__{side}_{c}")) for c in keys]
    incoming = small_side(mark(new, "new"))
    kept = old.join(incoming, same("new"), "left").filter(F.col("__new").isNull() | (F.struct(*order) > F.col("__new")))
    beaten = old.join(incoming, same("new"), "left_semi")
    added = new.join(mark(beaten, "old"), same("old"), "left").filter(F.col("__old").isNull() | (F.struct(*order) >= F.col("__old")))
    return kept.select(*old.columns).unionByName(added.select(*old.columns))
