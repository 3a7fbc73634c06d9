"""One large JSON document read by many tasks (SRC4).

A document is one file, or a folder of part files that are one document in name order. It is cut
into byte ranges, a task each:

1. every task counts quotes and brackets of its range twice over, for a start outside and inside a string.
   Ranges compose, so folding these few numbers in order gives the state, in a string or not and how
   deep, at the start of every range;
2. with that state every task reports the keys of the outer levels, which delimit the arrays of
   the document (``snapshots``, ``catalogo.productos``);
3. tasks whose range touches an asked array cut its elements. An element belongs to the range where it
   starts and is read beyond the end of it.

The driver holds a pair of numbers per range and the outer keys, both independent of the number of
elements. Elements leave as text, in document order by ``pos``, and are parsed by ``from_json``.

Arrays hold objects; an element may be of any size, a task holds one. Files are opened through the file system of
their URI. A document that ends within a string or with open brackets fails.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RANGE_BYTES = 64 << 20
BLOCK_BYTES = 1 << 20  # bytes that a task looks at together
KEY_BYTES = 4096  # longest outer key
MAX_OUTER_KEYS = 10_000
QUOTE, BACKSLASH, COLON = b'"\\:'


class Document:
    """Random access to the bytes of a file or of the part files of a folder."""

    def __init__(self, path: str):
        store, root = fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))
        info = store.get_file_info(root)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(path)
        if info.type == fs.FileType.Directory:
            found = sorted(store.get_file_info(fs.FileSelector(root, recursive=True)), key=lambda f: f.path)
            found = [f for f in found if f.type == fs.FileType.File and not f.base_name.startswith(("_", "."))]
        else:
            found = [info]
        self.store, self.paths, self.handles = store, [f.path for f in found], {}
        self.starts = np.concatenate(([0], np.cumsum([f.size for f in found]))).astype(np.int64).tolist()
        self.size = self.starts[-1]

    def read(self, at: int, n: int) -> bytes:
        out = b""
        n = min(n, self.size - at)
        while n > 0:
            i = bisect.bisect_right(self.starts, at) - 1
            if i not in self.handles:
                self.handles = {i: self.store.open_input_file(self.paths[i])}
            take = min(n, self.starts[i + 1] - at)
            out += self.handles[i].read_at(take, at - self.starts[i])
            at, n = at + take, n - take
        return out


def escaped_start(doc: Document, at: int) -> bool:
    """Whether an odd number of backslashes ends right before ``at``."""
    n = 64
    while True:
        before = doc.read(max(0, at - n), min(n, at))
        run = len(before) - len(before.rstrip(b"\\"))
        if run < len(before) or n >= at:
            return run % 2 == 1
        n *= 8


@dataclass
class Block:
    """Bytes of a document from ``at`` on. ``outside`` marks those that are not part of a string, ``step`` is
    +1 at an opening and -1 at a closing bracket wherever it stands, ``depth`` the number of open brackets
    before each byte; ``in_string`` and ``after`` are the state behind the last one."""
    at: int
    data: bytes
    codes: np.ndarray
    outside: np.ndarray
    step: np.ndarray
    depth: np.ndarray
    in_string: bool
    after: int

    def places(self, char: bytes) -> np.ndarray:
        return np.flatnonzero((self.codes == char[0]) & self.outside)


def walk(doc: Document, start: int, stop: int, in_string: bool, depth: int) -> Iterator[Block]:
    """Blocks of [start, stop) with their state."""
    odd = escaped_start(doc, start)
    for at in range(start, stop, BLOCK_BYTES):
        data = doc.read(at, min(BLOCK_BYTES, stop - at))
        codes = np.frombuffer(data, np.uint8)
        quotes = np.flatnonzero(codes == QUOTE)
        plain = codes != BACKSLASH
        if odd or not plain.all():  # a quote behind an odd run of backslashes is a character
            last = np.maximum.accumulate(np.where(plain, np.arange(len(codes)), -1))
            before = np.where(quotes > 0, last[quotes - 1], -1)
            run = quotes - 1 - before + np.where(before < 0, odd, 0)
            quotes = quotes[run % 2 == 0]
            odd = bool((len(codes) - 1 - int(last[-1]) + (odd if last[-1] < 0 else 0)) % 2)
        toggles = np.zeros(len(codes), np.int8)
        toggles[quotes] = 1
        inside = (np.cumsum(toggles, dtype=np.int32) + in_string) % 2 == 1
        outside = ~inside & (codes != QUOTE)
        step = ((codes == ord("{")) | (codes == ord("["))).astype(np.int32) - ((codes == ord("}")) | (codes == ord("]")))
        after = np.cumsum(step * outside, dtype=np.int32) + depth
        in_string, depth = bool(inside[-1]), int(after[-1])
        yield Block(at, data, codes, outside, step, after - step * outside, in_string, depth)


def ranges(doc: Document, size: int) -> list[tuple[int, int]]:
    return [(a, min(a + size, doc.size)) for a in range(0, doc.size, size)]


def summary(doc: Document, start: int, stop: int) -> tuple[bool, int, int]:
    """Of a range: does it flip the string state, and the change of depth from either state."""
    flips, outside, inside = False, 0, 0
    for b in walk(doc, start, stop, False, 0):
        flips, outside = b.in_string, b.after
        inside += int(b.step[~b.outside].sum())  # what is outside for one start is inside for the other
    return flips, outside, inside


def outer_keys(doc: Document, blocks: Iterator[Block]) -> Iterator[tuple[int, int, str]]:
    """(place, depth, key) of the keys at depths 1 and 2."""
    for b in blocks:
        for p in b.places(b":"):
            if b.depth[p] in (1, 2):
                at = b.at + int(p)
                before = doc.read(max(0, at - KEY_BYTES), min(KEY_BYTES, at)).rstrip()
                end = len(before) - 1
                begin = end - 1
                while begin >= 0 and (before[begin] != QUOTE or _run(before, begin) % 2):
                    begin -= 1
                if end < 1 or before[end] != QUOTE or begin < 0:
                    raise ValueError(f"no key of at most {KEY_BYTES} bytes before byte {at}")
                yield at, int(b.depth[p]), before[begin + 1:end].decode()


def _run(data: bytes, at: int) -> int:
    return len(data[:at]) - len(data[:at].rstrip(b"\\"))


def elements(doc: Document, start: int, stop: int, in_string: bool, depth: int, lo: int, hi: int, level: int) -> Iterator[tuple[int, bytes]]:
    """(place, text) of the objects that start in [start, stop) and [lo, hi) below ``level`` brackets."""
    open_at, held = None, []
    for b in walk(doc, start, doc.size, in_string, depth):
        if b.at >= stop and open_at is None:
            return
        begins, ends = b.places(b"{"), b.places(b"}")
        begins = begins[(b.depth[begins] == level) & (begins + b.at < min(stop, hi)) & (begins + b.at >= max(start, lo))]
        ends = ends[b.depth[ends] == level + 1]
        at = 0
        if open_at is not None:
            if not len(ends):
                held.append(b.data)
                continue
            held.append(b.data[:int(ends[0]) + 1])
            yield open_at, b"".join(held)
            open_at, held, at = None, [], int(ends[0]) + 1
        for p in begins.tolist():
            if p < at:
                continue
            i = int(np.searchsorted(ends, p))
            if i == len(ends):
                open_at, held = b.at + p, [b.data[p:]]
                break
            yield b.at + p, b.data[p:int(ends[i]) + 1]
            at = int(ends[i]) + 1
    if open_at is not None:
        raise ValueError(f"the element at byte {open_at} has no end")


class JsonDocument:
    """The boundary index of a document, and its arrays as DataFrames."""

    def __init__(self, spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES):
        self.spark, self.path, self.range_bytes = spark, path, range_bytes
        cut = ranges(Document(path), range_bytes)
        if not cut:
            raise ValueError(f"{path} is empty")
        found = self._tasks(cut, "i int, flips boolean, outside long, inside long", lambda doc, i, a, b: [(i, *summary(doc, a, b))])
        self.states, in_string, depth = [], False, 0
        for r in sorted(found.collect()):  # a row per range
            self.states.append((in_string, depth))
            depth += r["inside"] if in_string else r["outside"]
            in_string ^= r["flips"]
        if in_string or depth:
            raise ValueError(f"{path} ends {'within a string' if in_string else f'with {depth} open brackets'}")
        states = self.states
        keys = self._tasks(cut, "pos long, depth int, key string", lambda doc, i, a, b: outer_keys(doc, walk(doc, a, b, *states[i])))
        keys = sorted(keys.limit(MAX_OUTER_KEYS + 1).collect())
        if len(keys) > MAX_OUTER_KEYS:
            raise ValueError(f"more than {MAX_OUTER_KEYS} keys in the outer levels")
        self.cut, self.sections, parent = cut, {}, ""
        ends = [k["pos"] for k in keys[1:]] + [cut[-1][1]]
        for k, end in zip(keys, ends):
            parent = k["key"] if k["depth"] == 1 else parent
            name = k["key"] if k["depth"] == 1 else f"{parent}.{k['key']}"
            self.sections[name] = (k["pos"], end, k["depth"] + 1)

    def _tasks(self, cut: list, schema: str, work) -> DataFrame:
        """A task per (i, start, stop) of ``cut``."""
        path, fields = self.path, T.StructType.fromDDL(schema)
        numbered = [c if len(c) == 3 else (i, *c) for i, c in enumerate(cut)]

        def run(batches):
            from pyspark.sql.pandas.types import to_arrow_schema

            doc, kind = Document(path), to_arrow_schema(fields)
            for b in batches:
                for n in b.column("id").to_pylist():
                    held, size = [], 0
                    for row in work(doc, *numbered[n]):
                        held.append(row)
                        size += len(row[-1]) if isinstance(row[-1], bytes) else 1
                        if size > 8 << 20:
                            yield batch(held, kind)
                            held, size = [], 0
                    if held:
                        yield batch(held, kind)

        def batch(rows, kind):
            cols = [[v.decode() if isinstance(v, bytes) else v for v in c] for c in zip(*rows)]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, kind)], schema=kind)

        return self.spark.range(0, len(numbered), 1, max(1, len(numbered))).mapInArrow(run, fields)

    def texts(self, section: str) -> DataFrame:
        """(pos, element) of the objects of an array; only ranges that the array touches are read."""
        schema = "pos long, element string"
        if section not in self.sections:
            return self.spark.createDataFrame([], schema)
        lo, hi, level = self.sections[section]
        states = self.states
        touched = [(i, a, b) for i, (a, b) in enumerate(self.cut) if a < hi and b > lo]
        return self._tasks(touched, schema, lambda doc, i, a, b: elements(doc, a, b, *states[i], lo, hi, level))

    def rows(self, section: str, schema: T.StructType) -> DataFrame:
        """The objects of an array as rows; text that does not parse fails the job."""
        parsed = F.from_json("element", schema, {"mode": "FAILFAST"})
        return self.texts(section).select(parsed.alias("e")).select("e.*")


def read_inventory_document(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> dict[str, DataFrame]:
    """The nested inventory document -> {tiendas, sku_map, catalogo, snapshots}, like
    ``files.read_inventory_json``, in as many tasks as the document has ranges."""
    from kardex.operators.conform import clean_snapshots
    from kardex.sources.files import INVENTORY_SCHEMA
    from kardex.sources.nested import unnest_cost_history

    doc = JsonDocument(spark, path, range_bytes)
    of = lambda name: INVENTORY_SCHEMA[name].dataType.elementType
    products = INVENTORY_SCHEMA["catalogo"].dataType["productos"].dataType.elementType
    return {
        "tiendas": doc.rows("tiendas_info", of("tiendas_info")),
        "sku_map": doc.rows("sku_mappings", of("sku_mappings")),
        "catalogo": unnest_cost_history(doc.rows("catalogo.productos", products)),
        "snapshots": clean_snapshots(doc.rows("snapshots", of("snapshots"))),
    }


def write_document(tables: dict[str, DataFrame], path: str) -> None:
    """Write arrays of objects as one document in part files: ``name`` or ``outer.name`` -> rows. Each array
    is written in parallel and begins with a null, so that every object may follow a comma; the parts, read
    in name order, are the document."""
    spark = next(iter(tables.values())).sparkSession
    put = lambda text, step: _part(spark.createDataFrame([(text,)], "value string").coalesce(1), f"{path}/{step:04d}")
    opened = ""
    for n, (name, rows) in enumerate(tables.items()):
        outer, _, inner = name.rpartition(".")
        head = "{" if n == 0 else "," if opened == outer else "}," if opened else ","
        head += f'"{outer}":{{' if outer and outer != opened else ""
        opened = outer
        put(f'{head}"{inner}":[null', 3 * n)
        _part(rows.select(F.concat(F.lit(","), F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"})).alias("value")), f"{path}/{3 * n + 1:04d}")
        put("]", 3 * n + 2)
    put("}}" if opened else "}", 3 * len(tables))


def _part(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").text(path)
