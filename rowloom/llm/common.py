"""Small helpers shared by the text operators."""

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.functions.lineage import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def settled(df: DataFrame, name: str, codec: str | None = None, file_rows: int | None = None) -> DataFrame:
    """Written once as Parquet in the shared folder and read back: not computed twice, safe against lost executors, and Spark
    knows its true size when it plans a join. Parquet's writer counts bytes only every 100 rows and its reader takes thousands at
    once, so tables with rows of megabytes name `file_rows`, which bounds what either holds."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(**({"maxRecordsPerFile": file_rows} if file_rows else {})).parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, body) -> Column:
    """Bind a value once for use inside lambdas; a plain column would be computed again for every element."""
    return F.transform(F.array(value), body)[0]


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, nothing else; texts of ASCII alone take the fast path."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def text_key(text: str = "text") -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_MULTIPLIER), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_powers = np.ones(1, np.uint64)
_backs = np.ones(1, np.uint64)


def _tables(n: int):
    global _powers, _backs
    if len(_powers) <= n:
        size = max(2 * len(_powers), n + 1, 1 << 16)
        steps = np.full(size, _MULTIPLIER, np.uint64)
        steps[0] = 1
        _powers = np.cumprod(steps)
        steps[1:] = _INVERSE
        _backs = np.cumprod(steps)
    return _powers, _backs


_BYTES = mix(np.arange(1, 257, dtype=np.uint64))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """P with P[e] - P[s] the polynomial of bytes s..e-1, to be brought to a common place by `span_hash`."""
    powers, _ = _tables(len(data))
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * powers[: len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans; equal bytes give equal hashes wherever they stand."""
    _, backs = _tables(len(prefix))
    return mix((prefix[ends] - prefix[starts]) * backs[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_spans(parts: list[list]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(prefix sums, starts, ends, counts) of texts given as lists of words in bytes, laid out with one space between words."""
    counts = np.array([len(p) for p in parts], np.int64)
    data = np.frombuffer(b" ".join(b" ".join(p) for p in parts if p), np.uint8)
    blank = np.flatnonzero(data == 32)
    none = np.zeros(0, np.int64)
    starts = np.concatenate([[0], blank + 1]) if len(data) else none
    ends = np.concatenate([blank, [len(data)]]) if len(data) else none
    return prefix_sums(data), starts, ends, counts


def text_chunks(batch, text: str, size: int = 1 << 20):
    """(slice, texts): pieces of an Arrow batch with about `size` characters each."""
    texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
    group = np.cumsum([len(t or "") for t in texts]) // size
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(texts)]
    for a, b in zip(cuts[:-1], cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a), texts[a:b]
