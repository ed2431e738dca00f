"""Tables of immutable Parquet files whose current version is named last (S04, S05, S09,
S10, S15, S19, X01).

A load writes its files into a folder of its own and then commits one small manifest, the
next number in ``_log``, by a rename that fails if that number is taken.  Readers take the
newest manifest and read just the files it names, so they see the table before a load or
after it and never half of it; a load that dies leaves files no manifest names, which
``vacuum`` removes.  The manifest also holds what must be committed together with the data:

* the ledger of batch ids: a batch that is there is not loaded again;
* the ledger of date slices with their row counts: missing days are found and only these
  loaded;
* for keyed tables the folders of the key index: for each file the range of its keys'
  hashes and a Bloom filter of them, so an upsert rewrites only files that hold one of
  its keys.

On the driver lie names and counts, a line for each file or slice.  Rows, keys and
filters stay in Spark.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seasonflow.operators.dedup import dedup_latest

ROWS_PER_FILE = 100_000
FILTER_KEYS = 4_096          # keys that share one filter of 32,768 bits (about one false answer in nine)
_BITS = 32_768
_RANGE_SHIFT = 52            # hash ranges are matched by their top twelve bits


class Conflict(RuntimeError):
    """Another writer committed first; the load can be run again."""


def content_id(df: DataFrame) -> str:
    """An id of a frame's rows, whatever their order: count and sum of row hashes."""
    h = F.xxhash64(*[F.to_json(F.struct(F.col(f"`{c}`"))) for c in df.columns])
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(h.cast("decimal(38,0)")).alias("s"),
               F.sum(F.xxhash64(h).cast("decimal(38,0)")).alias("t")).first()
    names = ",".join(sorted(df.columns))
    return uuid.uuid5(uuid.NAMESPACE_OID, f"{names}|{r.n}|{r.s}|{r.t}").hex


class Table:
    """A table under ``path``; ``keys`` are needed for ``upsert``."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str] = (), rows_per_file: int = ROWS_PER_FILE):
        self.spark, self.path, self.keys, self.rows_per_file = spark, path.rstrip("/"), list(keys), rows_per_file
        self._jvm = spark.sparkContext._jvm
        self._conf = spark._jsparkSession.sessionState().newHadoopConf()
        self._fs = self._p("").getFileSystem(self._conf)

    # -- files -------------------------------------------------------------------------------
    def _p(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def _names(self, folder: str) -> list[str]:
        """All files below a folder, relative to the table."""
        out, root = [], self._fs.makeQualified(self._p("")).toString().rstrip("/") + "/"
        if not self._fs.exists(self._p(folder)):
            return out
        it = self._fs.listFiles(self._p(folder), True)
        while it.hasNext():
            out.append(it.next().getPath().toString().removeprefix(root))
        return sorted(out)

    def _text(self, name: str) -> str:
        stream = self._fs.open(self._p(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    # -- manifests -----------------------------------------------------------------------------
    def versions(self) -> list[int]:
        return sorted(int(n.rsplit("/", 1)[1][:-5]) for n in self._names("_log") if n.endswith(".json"))

    def manifest(self, version: int | None = None) -> dict:
        known = self.versions()
        if not known:
            return {"version": -1, "files": [], "schema": None, "batches": {}, "slices": {}, "index": []}
        return json.loads(self._text(f"_log/{known[-1] if version is None else version:08d}.json"))

    def _commit(self, before: dict, **changes) -> dict:
        now = {**before, **changes, "version": before["version"] + 1}
        draft, final = f"_log/.{uuid.uuid4().hex}", f"_log/{now['version']:08d}.json"
        out = self._fs.create(self._p(draft))
        out.write(bytearray(json.dumps(now).encode()))
        out.close()
        rename = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._p("").toUri(), self._conf)
        try:
            context.rename(self._fs.makeQualified(self._p(draft)), self._fs.makeQualified(self._p(final)),
                           self.spark.sparkContext._gateway.new_array(rename, 0))
        except Exception as e:
            self._fs.delete(self._p(draft), False)
            if self._fs.exists(self._p(final)):
                raise Conflict(f"version {now['version']} of {self.path} is taken") from e
            raise
        return now

    # -- reading -------------------------------------------------------------------------------
    def read(self, version: int | None = None) -> DataFrame:
        """The table as of a version (default: the newest).  Columns that a file lacks are NULL."""
        m = self.manifest(version)
        if m["schema"] is None:
            raise ValueError(f"{self.path} has no version yet")
        return self._of(m, m["files"])

    def _of(self, m: dict, files: Sequence[str]) -> DataFrame:
        schema = T.StructType.fromJson(m["schema"])
        if not files:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{f}" for f in files])

    def has_batch(self, batch_id: str) -> bool:
        return batch_id in self.manifest()["batches"]

    # -- writing ---------------------------------------------------------------------------------
    def _write(self, df: DataFrame, partition_by: Sequence[str] = ()) -> tuple[list[str], int]:
        """New files in a folder of their own, and their rows, counted in the same pass.
        ``partition_by`` cuts files by the columns' values; the columns stay in the files."""
        folder, seen = f"data/{uuid.uuid4().hex}", Observation()
        df = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        by = [f"by_{c}" for c in partition_by]
        w = df.withColumns({f"by_{c}": F.col(c) for c in partition_by}).write if by else df.write
        (w.partitionBy(*by) if by else w).parquet(f"{self.path}/{folder}")
        return [n for n in self._names(folder) if n.endswith(".parquet")], seen.get["rows"]

    def _schema(self, m: dict, df: DataFrame) -> dict:
        """The table's schema with new columns of ``df`` at its end; a known column keeps its type."""
        if m["schema"] is None:
            return json.loads(T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema]).json())
        old = T.StructType.fromJson(m["schema"])
        for f in df.schema:
            if f.name in old.names and old[f.name].dataType != f.dataType:
                raise ValueError(f"column {f.name} is {old[f.name].dataType.simpleString()}, not {f.dataType.simpleString()}")
        more = [T.StructField(f.name, f.dataType, True) for f in df.schema if f.name not in old.names]
        return json.loads(T.StructType([*old.fields, *more]).json())

    def replace(self, df: DataFrame, partition_by: Sequence[str] = (), batch_id: str | None = None) -> int:
        """The table becomes ``df``; returns the version.  ``df`` may read the table itself.
        The ledger of batches goes on, slices are forgotten."""
        m = self.manifest()
        if batch_id is not None and batch_id in m["batches"]:
            return m["version"]
        files, rows = self._write(self._clustered(df) if self.keys else df, partition_by)
        schema = self._schema({"schema": None}, df)
        index = self._index({**m, "schema": schema}, files)
        return self._commit(m, files=files, schema=schema, index=index, slices={},
                            batches={**m["batches"], **({batch_id: rows} if batch_id is not None else {})})["version"]

    def append(self, df: DataFrame, batch_id: str | None = None, partition_by: Sequence[str] = ()) -> bool:
        """Adds the rows unless the batch is in the ledger; whether they were added.
        Without an id the batch is known by its content."""
        m, batch_id = self.manifest(), batch_id or content_id(df)
        if batch_id in m["batches"]:
            return False
        files, rows = self._write(self._clustered(df) if self.keys else df, partition_by)
        schema = self._schema(m, df)
        self._commit(m, files=m["files"] + files, schema=schema, index=m["index"] + self._index({**m, "schema": schema}, files),
                     batches={**m["batches"], batch_id: rows})
        return True

    # -- keyed tables ------------------------------------------------------------------------------
    def _hash(self) -> Column:
        return F.xxhash64(*[F.col(f"`{k}`") for k in self.keys])

    def _clustered(self, df: DataFrame, files: int | None = None) -> DataFrame:
        """Rows ordered by their keys' hash, so that a file holds a narrow range of it."""
        n = files or max(1, -(-df.count() // self.rows_per_file))
        return df.repartitionByRange(n, self._hash())

    def _filters(self) -> int:
        return max(1, -(-self.rows_per_file // FILTER_KEYS))

    def _index(self, m: dict, files: Sequence[str]) -> list[str]:
        """Writes the index of new files: per file and filter the hash range and the bits."""
        if not self.keys or not files:
            return []
        h = self._of(m, files).select(self._hash().alias("h"), F.element_at(F.split("_metadata.file_path", "/data/"), -1).alias("file"))
        lines = h.groupBy("file", F.pmod(F.shiftright("h", 20), F.lit(self._filters())).cast("int").alias("filter")).agg(
            F.min("h").alias("lo"), F.max("h").alias("hi"), F.count(F.lit(1)).alias("rows"),
            F.bitmap_construct_agg(F.pmod("h", F.lit(_BITS))).alias("bits"))
        folder = f"index/{uuid.uuid4().hex}"
        lines.write.parquet(f"{self.path}/{folder}")
        return [folder]

    def files_with(self, keys: DataFrame, m: dict | None = None) -> list[str]:
        """Files that may hold one of the keys: every file that does, and few others."""
        m = m or self.manifest()
        if not m["files"]:
            return []
        live = self.spark.createDataFrame([(f.removeprefix("data/"),) for f in m["files"]], "file string")
        index = self.spark.read.parquet(*[f"{self.path}/{i}" for i in m["index"]]).join(live, "file", "left_semi")
        asked = keys.select(self._hash().alias("h")).distinct()
        top = lambda c: F.shiftright(c, _RANGE_SHIFT)
        ranges = index.select("file", "filter", "lo", "hi", "bits", F.explode(F.sequence(top("lo"), top("hi"))).alias("at"))
        near = asked.select("h", top("h").alias("at"), F.pmod(F.shiftright("h", 20), F.lit(self._filters())).cast("int").alias("filter"))
        place = F.pmod("h", F.lit(_BITS)).cast("int")
        byte = F.conv(F.hex(F.substring("bits", (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        held = F.expr("shiftright(b, cast(p % 8 as int)) & 1") == 1
        hits = (near.join(ranges, ["at", "filter"]).where(F.col("h").between(F.col("lo"), F.col("hi")))
                .select("file", byte.alias("b"), place.alias("p")).where(held).select("file").distinct())
        return sorted(f"data/{r.file}" for r in hits.collect())      # at most a line a file

    def upsert(self, delta: DataFrame, order_by: Sequence[Column], batch_id: str | None = None) -> dict:
        """The newest row of each key among the stored rows and ``delta``, by ``order_by``
        (which must decide ties), so a late row of an older state changes nothing and a
        batch may come twice or out of order.  Only files that hold a key of the batch are
        read and written again.  Returns ``files`` and ``rewritten`` (of them)."""
        if not self.keys:
            raise ValueError("an upsert needs the table's keys")
        m = self.manifest()
        if batch_id is not None and batch_id in m["batches"]:
            return {"files": len(m["files"]), "rewritten": 0}
        schema = self._schema(m, delta)
        new = dedup_latest(delta, self.keys, order_by)
        old = self.files_with(new, m)
        stored = self._of({**m, "schema": schema}, old)
        merged = dedup_latest(stored.unionByName(new, allowMissingColumns=True), self.keys, order_by)
        files, _ = self._write(self._clustered(merged, len(old)) if old else self._clustered(merged))
        if old and len(files) == len(old) == 1 and self._rows(m, files, schema) > 2 * self.rows_per_file:
            files, _ = self._write(self._clustered(self._of({**m, "schema": schema}, files)))
        gone = set(old)
        index = m["index"] + self._index({**m, "schema": schema}, files)
        left = [f for f in m["files"] if f not in gone] + files
        if len(index) > 20:
            index = self._one_index(index, left)
        batches = {**m["batches"], **({batch_id: len(files)} if batch_id is not None else {})}
        self._commit(m, files=left, schema=schema, index=index, batches=batches)
        return {"files": len(m["files"]), "rewritten": len(old)}

    def _rows(self, m: dict, files: Sequence[str], schema: dict) -> int:
        return self._of({**m, "schema": schema}, files).count()

    def _one_index(self, folders: Sequence[str], files: Sequence[str]) -> list[str]:
        live = self.spark.createDataFrame([(f.removeprefix("data/"),) for f in files], "file string")
        folder = f"index/{uuid.uuid4().hex}"
        (self.spark.read.parquet(*[f"{self.path}/{i}" for i in folders]).join(live, "file", "left_semi")
         .coalesce(8).write.parquet(f"{self.path}/{folder}"))
        return [folder]

    # -- date slices -------------------------------------------------------------------------------
    def missing_slices(self, start: _dt.date, end: _dt.date) -> list[_dt.date]:
        """Days from ``start`` to ``end`` that no load has committed."""
        done = self.manifest()["slices"]
        days = [start + _dt.timedelta(days=i) for i in range((end - start).days + 1)]
        return [d for d in days if d.isoformat() not in done]

    def load_slices(self, df: DataFrame, date_col: str, start: _dt.date, end: _dt.date, again: bool = False) -> list[_dt.date]:
        """Loads the missing days (all days with ``again``), each row stamped with its
        ``slice_date``; a day without rows is committed with 0.  Returns the loaded days."""
        days = self.missing_slices(start, end) if not again else [
            start + _dt.timedelta(days=i) for i in range((end - start).days + 1)]
        if not days:
            return []
        m = self.manifest()
        sliced = df.withColumn("slice_date", F.col(date_col).cast("date"))
        sliced = sliced.where(F.col("slice_date").isin(*days))
        files, _ = self._write(sliced, ["slice_date"])
        schema = self._schema(m, sliced)
        there = self._of({**m, "schema": schema}, files).groupBy("slice_date").count().collect()     # a line a day
        counts = {d.isoformat(): 0 for d in days} | {r.slice_date.isoformat(): r["count"] for r in there}
        old = tuple(f"/by_slice_date={d.isoformat()}/" for d in days)
        self._commit(m, files=[f for f in m["files"] if not any(o in f for o in old)] + files, schema=schema,
                     slices={**m["slices"], **counts})
        return days

    def drop_slice(self, day: _dt.date) -> None:
        """Forgets a day, with its rows, so that the next load brings it again."""
        m = self.manifest()
        self._commit(m, files=[f for f in m["files"] if f"/by_slice_date={day.isoformat()}/" not in f],
                     slices={k: v for k, v in m["slices"].items() if k != day.isoformat()})

    # -- old versions ------------------------------------------------------------------------------
    def vacuum(self, keep: int = 1) -> int:
        """Removes manifests but the newest ``keep`` and files that none of these names; how
        many files went.  Not to be run beside a load, whose files are not named yet."""
        known = self.versions()
        kept = [self.manifest(v) for v in known[-keep:]]
        files, folders = {f for m in kept for f in m["files"]}, {i for m in kept for i in m["index"]}
        for v in known[:-keep]:
            self._fs.delete(self._p(f"_log/{v:08d}.json"), False)
        gone = [n for n in self._names("data") if n.endswith(".parquet") and n not in files]
        gone += [n for n in self._names("index") if n.endswith(".parquet") and n.rsplit("/", 1)[0] not in folders]
        for n in gone:
            self._fs.delete(self._p(n), False)
        return len(gone)
