"""What the operators share: the cluster's scratch folder, stored tables, shipped code, small text helpers."""

from __future__ import annotations

import atexit
import ctypes
import os
import shutil
import tempfile
import uuid
import weakref
from collections.abc import Callable, Iterator, Sequence
from functools import wraps
from pathlib import Path

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession

_SHIPPED: weakref.WeakSet = weakref.WeakSet()
_OWN: dict[str, str] = {}

BATCH_BYTES = 6_000_000  # or one row

#: Upper-case ASCII letters to lower case; every other ASCII byte outside [0-9a-z] to a space.
ALNUM_BYTES = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in bytes(range(256)).lower())


def scratch_dir(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``, which driver and executors share.

    Only where that setting is absent in a local session is it a temporary folder of this machine; on a cluster its absence is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines of the cluster share")
        if "dir" not in _OWN or not os.path.isdir(_OWN["dir"]):
            _OWN["dir"] = tempfile.mkdtemp(prefix="bizmetrics-")
        base = "file://" + _OWN["dir"]
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str = "table") -> DataFrame:
    """``df`` written to the shared folder and read again: computed once, and safe from lost executors."""
    path = f"{scratch_dir(df.sparkSession)}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bound_batches(spark: SparkSession) -> None:
    """Bound the bytes of a batch that goes to Python, where the session doesn't: 10,000 rows of long texts may have any size."""
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once per session, wherever its folder lies; batches for it are bounded."""
    bound_batches(spark)
    context = spark.sparkContext
    if context in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[2]
    folder = tempfile.mkdtemp(prefix="bizmetrics-code-")  # the driver serves the archive from here as long as it runs
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    copy = Path(folder, "copy", "bizmetrics")
    shutil.copytree(root / "bizmetrics", copy, ignore=shutil.ignore_patterns("__pycache__"))
    context.addPyFile(shutil.make_archive(str(Path(folder, f"bizmetrics-{uuid.uuid4().hex[:8]}")), "zip", copy.parent))
    _SHIPPED.add(context)


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` over a task's batches; at its end, memory that it no longer uses goes back to the system.

    Workers go on to other tasks, and what one operator needed at its height would else stay with them.
    """

    @wraps(run)
    def tidied(batches: Iterator) -> Iterator:
        yield from run(batches)
        give_back()

    return tidied


def give_back() -> None:
    """Return freed memory to the system, where the C library can."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def file_system(uri: str):
    """The file system of a URI, and the path in it; for code in tasks."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}" if uri.startswith("/") else uri.replace("file:/", "file:///", 1))


def utf8(text: str | None) -> bytes:
    """A text's bytes; null is empty."""
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def alnum_words(text: str | None) -> list[bytes]:
    r"""Words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of the text with A-Z in lower case, as UTF-8."""
    return utf8(text).translate(ALNUM_BYTES).split()


def spaced_words(text: str | None) -> list[bytes]:
    r"""Words ``[^\x20\x09-\x0D]+`` of the text with A-Z in lower case, as UTF-8."""
    return utf8(text).lower().split()


def hashed(words: Sequence[bytes]) -> np.ndarray:
    """A 64-bit hash of each word."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def slices(table, text_column: str, max_chars: int) -> Iterator:
    """An Arrow batch in slices of at most ``max_chars`` bytes of text, or a single row."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(table.column(text_column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = np.cumsum(sizes) // max_chars if len(sizes) else sizes
    cuts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(sizes)]
    for begin, end in zip(cuts, cuts[1:], strict=False):
        if end > begin:
            yield table.slice(begin, end - begin)


def mix64(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit integers (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(30))
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x
