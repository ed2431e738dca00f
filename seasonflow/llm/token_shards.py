"""Training-order materialisation of token sequences as fixed-stride binary shards.

A keyed Feistel network with cycle-walking permutes the numbers 0 .. n - 1, so it
gives every sequence its global slot in training order without sorting or storing
a shuffle.  Slots are range-partitioned into shards; a record's place follows from
its slot alone, so a reader starts anywhere and a run that stopped goes on.

Shape at scale: sequences are tokenised once into a written table.  Shards are
written in waves, each a range of slots, so only a part of the ids is in shuffle
files at a time.  A shard is one task's sequential write, under a name of its own
until it is whole; a shard that is there is not written again.  The table of sequences
lies beside the shards, so a run that goes on numbers them as the first one did; the
manifest names the documents' digest and all parameters, and a folder of other documents
or parameters is refused.
"""

from __future__ import annotations

import json
import uuid
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, filesystem, flat_text, map_arrow, mix64, narrow_batches, new_path, own_columns
from .packing import pieces
from .tokens import public_path

TOKENIZER = "byte_bpe_50k.tiktoken"     # lossless; its free id ends a document
END_ID = 50256
ROUNDS = 6
MANIFEST = "manifest.json"
BEGUN, SEQUENCES = "run.json", "_sequences"
_ROW_BITS = 33                    # of monotonically_increasing_id: partition, then row


def _network(x: np.ndarray, half: int, key: int) -> np.ndarray:
    mask = np.uint64((1 << half) - 1)
    left, right = x >> np.uint64(half), x & mask
    for r in range(ROUNDS):
        f = mix64(right + np.uint64((key * 0x9E3779B97F4A7C15 + (r + 1) * 0xD6E8FEB86659FD93) % (1 << 64))) & mask
        left, right = right, left ^ f
    return (left << np.uint64(half)) | right


def permute(x: np.ndarray, n: int, key: int) -> np.ndarray:
    """The slot of each number below ``n``: a bijection of 0 .. n - 1."""
    half = max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)
    out = _network(np.asarray(x, np.uint64), half, key)
    while (far := out >= np.uint64(n)).any():       # walk the cycle back into the domain
        out[far] = _network(out[far], half, key)
    return out.astype(np.int64)


def _record(dtype: str, length: int) -> np.dtype:
    return np.dtype([("length", "<u4"), ("ids", dtype, (length,))])


def _digest(docs: DataFrame, id_col: str, text_col: str) -> str:
    """Of all rows' ids and texts, whatever their order."""
    h = F.xxhash64(F.col(f"`{id_col}`").cast("string"), F.col(f"`{text_col}`"), F.lit(5)).cast("decimal(38,0)")
    n, a = docs.agg(F.count(F.lit(1)), F.sum(h)).first()
    return f"{n}:{a or 0}"


def write_shards(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text",
                 tokenizer: str | None = None, sequence: int = 512, dtype: str = "<u2", end_id: int = END_ID, key: int = 2024,
                 shard_records: int = 16_384, waves: int = 4, scratch: Scratch | None = None) -> tuple[str, DataFrame]:
    """Writes the shards and returns their folder and the index: ``doc_id, start,
    length, slot, shard, shard_offset`` (in bytes), one row per sequence.

    A document's ids and an end id are cut into sequences of ``sequence`` ids; the
    last is padded with zeros in its record, which begins with the true length.
    Null text is empty, that is the end id alone; rows with equal ids are separate
    documents; no documents give a manifest and no shards.  ``dtype`` must hold the
    vocabulary, else an id that doesn't fit is an error.  Numbering follows the written
    table of sequences, so retried tasks agree, and so does a second run over the same
    documents, however they are partitioned: it writes the shards that lack.  A folder
    that was begun with other documents or parameters is a ``ValueError``.
    """
    own_columns(docs, id_col, text_col)
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark)
    path = path or new_path(spark, "shards")
    fs, folder = filesystem(path)
    how = {"sequence": sequence, "dtype": dtype, "shard_records": shard_records, "key": key, "end_id": end_id,
           "tokenizer": (tokenizer or TOKENIZER).rsplit("/", 1)[-1]}
    run = {**how, "documents": _digest(docs, id_col, text_col)}
    begun = fs.get_file_info(f"{folder}/{BEGUN}").type == pafs.FileType.File
    if begun:
        with fs.open_input_stream(f"{folder}/{BEGUN}") as f:
            old = json.loads(f.read())
        if old != run:
            raise ValueError(f"{path} was begun with other {', '.join(k for k in run if run[k] != old.get(k))}")
    else:
        if fs.get_file_info(f"{folder}/{MANIFEST}").type == pafs.FileType.File:
            raise ValueError(f"{path} holds shards of another run")
        fs.create_dir(folder, recursive=True)
    kept = f"{path}/{SEQUENCES}"
    if not begun:
        cut = pieces(docs, id_col, text_col, tokenizer or public_path(TOKENIZER), sequence, end_id, with_ids=True, dtype=dtype,
                     piece=sequence)
        table = cut.select("doc_id", "start", "length", "ids").withColumn("at", F.monotonically_increasing_id())
        # a table that a stopped run left half-way is written anew; it counts once the run's file is there
        table.write.mode("overwrite").option("compression", "zstd").parquet(kept)
        with fs.open_output_stream(f"{folder}/{BEGUN}") as out:
            out.write(json.dumps(run).encode())
    table = spark.read.parquet(kept)
    # a number per partition that was written
    rows = sorted((r.p, r.n) for r in table.groupBy(F.shiftright("at", _ROW_BITS).alias("p"))
                  .agg(F.count(F.lit(1)).alias("n")).collect())
    n = sum(c for _, c in rows)
    part = np.array([p for p, _ in rows], np.int64)
    base = np.cumsum([0, *(c for _, c in rows)])[:-1]

    @F.pandas_udf("long")
    def slot_of(at: pd.Series) -> pd.Series:
        a = at.to_numpy()
        index = base[np.searchsorted(part, a >> _ROW_BITS)] + (a & ((1 << _ROW_BITS) - 1))
        return pd.Series(permute(index, n, key))

    record = _record(dtype, sequence)
    shards = -(-n // shard_records)
    with fs.open_output_stream(f"{folder}/{MANIFEST}") as out:
        out.write(json.dumps({"sequences": n, "sequence": sequence, "dtype": dtype, "stride": record.itemsize,
                              "shard_records": shard_records, "shards": shards, "key": key}).encode())

    def write(batches):
        """Rows come in slot order, shard by shard."""
        fs, folder = filesystem(path)
        now, out, temp, skip = -1, None, "", False

        def close():
            if out is not None:
                out.close()
                fs.move(temp, f"{folder}/{shard_name(now)}")

        for b in batches:
            slot, length = b.column(0).to_numpy(), b.column(1).to_numpy()
            data = np.zeros(len(slot), record)
            data["length"] = length
            flat, _ = flat_text(b.column(2))
            data["ids"][np.arange(sequence) < length[:, None]] = flat.view(dtype)
            shard = slot // shard_records
            for s in np.unique(shard):
                if s != now:
                    close()
                    now, out = int(s), None
                    skip = fs.get_file_info(f"{folder}/{shard_name(now)}").type == pafs.FileType.File
                    if not skip:
                        temp = f"{folder}/{shard_name(now)}.{uuid.uuid4().hex}"
                        out = fs.open_output_stream(temp, compression=None)
                if not skip:
                    out.write(data[shard == s].tobytes())
        close()
        yield pa.RecordBatch.from_arrays([pa.array([now], pa.int64())], ["shard"])

    slotted = table.withColumn("slot", slot_of("at"))
    for wave in range(waves):
        low, high = shards * wave // waves, shards * (wave + 1) // waves
        if low == high:
            continue
        mine = slotted.where(F.col("slot").between(low * shard_records, high * shard_records - 1))
        dealt = mine.select("slot", "length", "ids").repartitionById(
            high - low, (F.floor(F.col("slot") / shard_records) - low).cast("int")).sortWithinPartitions("slot")
        written = map_arrow(dealt, write, "shard long").agg(F.count(F.lit(1)))
        narrow_batches(spark)
        written.first()
    shard = F.floor(F.col("slot") / shard_records)
    index = slotted.select("doc_id", "start", "length", "slot", shard.alias("shard"),
                           ((F.col("slot") - shard * shard_records) * record.itemsize).alias("shard_offset"))
    return path, index


def shard_name(k: int) -> str:
    return f"shard-{k:08d}.bin"


def read_slots(spark: SparkSession, path: str, first: int = 0, count: int | None = None, with_ids: bool = True) -> DataFrame:
    """``slot, length, ids_crc32`` (over little-endian uint32 ids) and, with
    ``with_ids``, ``ids``, for ``count`` slots from ``first`` on (all by default).
    Each task opens one shard and seeks to its first record."""
    fs, folder = filesystem(path)
    with fs.open_input_stream(f"{folder}/{MANIFEST}") as f:
        m = json.loads(f.read())
    end = m["sequences"] if count is None else min(m["sequences"], first + count)
    record, size = _record(m["dtype"], m["sequence"]), m["shard_records"]
    schema = "slot long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    wanted = range(first // size, -(-end // size)) if first < end else range(0)

    def read(batches):
        fs, folder = filesystem(path)
        for b in batches:
            for s in b.column(0).to_pylist():
                low, high = max(first, s * size), min(end, (s + 1) * size)
                with fs.open_input_file(f"{folder}/{shard_name(s)}") as f:
                    f.seek((low - s * size) * record.itemsize)
                    while low < high:
                        k = min(high - low, max(1, (4 << 20) // record.itemsize))
                        data = np.frombuffer(f.read(k * record.itemsize), record)
                        length, ids = data["length"].astype(np.int64), np.ascontiguousarray(data["ids"], "<u4")
                        cols = [pa.array(np.arange(low, low + k)), pa.array(length),
                                pa.array([zlib.crc32(x[:n]) for x, n in zip(ids, length, strict=True)], pa.int64())]
                        if with_ids:
                            cols.append(pa.ListArray.from_arrays(
                                pa.array(np.r_[0, np.cumsum(length)], pa.int32()),
                                pa.array(ids[np.arange(ids.shape[1]) < length[:, None]].astype(np.int32))))
                        yield pa.RecordBatch.from_arrays(cols, ["slot", "length", "ids_crc32", "ids"][:len(cols)])
                        low += k

    return map_arrow(spark.range(wanted.start, wanted.stop, 1, max(1, len(wanted))), read, schema)
