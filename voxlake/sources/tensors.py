"""Tensors in `.npy` files as a table, read by ranges of rows and written in parts, with their subject indices beside them.

A tensor's first axis counts subjects; `{file}_subject.csv` names them, row by row. A folder may hold plain files, each a
tensor, or parts of tensors under a manifest: the newest `_manifest/{version}.json` lists the parts that are valid, in
order, with their numbers of rows. Writers add parts under new names and publish the next version when all of them are
there, so readers see all of a write or nothing, and a part that isn't touched keeps its name.
"""

from __future__ import annotations

import csv
import io
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

SCHEMA = "path string, tensor string, row_idx long, subject_id string, shape array<int>, values array<float>"
ROW = "tensor string, row_idx long, subject_id string, shape array<int>, values array<float>"
#: Bytes that a task reads of a file, that are read at once, and of a part that is written.
PARTITION_BYTES, SLAB_BYTES, FILE_BYTES = 64 << 20, 8 << 20, 64 << 20
MANIFEST, INDEX = "_manifest", "_subject.csv"


def open_folder(path: str) -> tuple[fs.FileSystem, str]:
    store, root = fs.FileSystem.from_uri(path)
    return store, root.rstrip("/")


def versions(store: fs.FileSystem, root: str) -> list[int]:
    found = store.get_file_info(fs.FileSelector(f"{root}/{MANIFEST}", allow_not_found=True))
    return sorted(int(f.base_name.removesuffix(".json")) for f in found if f.base_name.endswith(".json"))


def parts(store: fs.FileSystem, root: str) -> list[dict]:
    """The valid parts (file, tensor, at: number of the first row, n) in order; files without a manifest are tensors of their own."""
    if known := versions(store, root):
        with store.open_input_stream(f"{root}/{MANIFEST}/{known[-1]:08d}.json") as f:
            return json.loads(f.read())
    found = store.get_file_info(fs.FileSelector(root, recursive=True))
    names = sorted(f.path[len(root) + 1 :] for f in found if f.is_file and f.path.endswith(".npy"))
    return [{"file": n, "tensor": n.removesuffix(".npy"), "at": 0, "n": None} for n in names]


def publish(store: fs.FileSystem, root: str, new: list[dict], replaced: list[str], fresh: bool) -> None:
    """The next version of the manifest: what was valid, unless it is `fresh`, without `replaced` and with the `new` parts, numbered anew. One writer at a time."""
    known = versions(store, root)
    old = [] if fresh or not known else parts(store, root)
    if old and not replaced:  # rows are added behind those that are there
        end: dict[str, int] = {}
        for p in old:
            end[p["tensor"]] = end.get(p["tensor"], 0) + p["n"]
        new = [p | {"at": p["at"] + end.get(p["tensor"], 0)} for p in new]
    gone, out, at = set(replaced), [], {}
    for p in sorted([p for p in old if p["file"] not in gone] + new, key=lambda p: (p["tensor"], p["at"])):
        first = at.get(p["tensor"], 0)
        out.append(p | {"at": first})
        at[p["tensor"]] = first + p["n"]
    target = f"{root}/{MANIFEST}/{(known[-1] if known else 0) + 1:08d}.json"
    store.create_dir(f"{root}/{MANIFEST}", recursive=True)
    with store.open_output_stream(draft := f"{target}.{uuid.uuid4().hex}") as f:
        f.write(json.dumps(out).encode())
    if store.get_file_info(target).type != fs.FileType.NotFound:
        raise RuntimeError(f"another writer has published {target}")
    store.move(draft, target)


@dataclass
class Rows(InputPartition):
    """Rows lo to hi of a file of n rows; `first` is the number of row lo in its tensor."""

    file: str
    tensor: str
    first: int
    lo: int
    hi: int
    n: int
    begin: int
    dtype: str
    shape: tuple
    indexed: bool


class ArrayReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.only = options["path"], options.get("files")
        self.most, self.ids = int(options.get("partitionbytes", PARTITION_BYTES)), options.get("ids", "false") == "true"

    def partitions(self) -> list[Rows]:
        store, root = open_folder(self.path)
        only = set(json.loads(self.only)) if self.only else None
        out = []
        for p in parts(store, root):
            if only is not None and p["file"] not in only:
                continue
            with store.open_input_file(f"{root}/{p['file']}") as f:
                head = io.BytesIO(f.read(1 << 16))
            major, _ = np.lib.format.read_magic(head)
            shape, by_column, dtype = (np.lib.format.read_array_header_1_0 if major == 1 else np.lib.format.read_array_header_2_0)(head)
            if by_column or dtype.hasobject or not shape:
                raise ValueError(f"{p['file']}: only arrays of numbers with rows one after the other can be read")
            n, size = shape[0], max(1, dtype.itemsize * int(np.prod(shape[1:])))
            if p["n"] not in (None, n):
                raise ValueError(f"{p['file']} has {n} rows, the manifest says {p['n']}")
            indexed = store.get_file_info(f"{root}/{p['file'].removesuffix('.npy')}{INDEX}").is_file
            step = max(1, n if self.ids else self.most // size)
            out += [Rows(p["file"], p["tensor"], p["at"] + lo, lo, min(n, lo + step), n, head.tell(), dtype.str, tuple(map(int, shape[1:])), indexed) for lo in range(0, n, step)]
        return out

    def subjects(self, store: fs.FileSystem, root: str, p: Rows) -> Iterator[str | None]:
        """Names of rows lo to hi; the last range also checks that there is a name for each row and no more."""
        if not p.indexed:
            yield from [None] * (p.hi - p.lo)
            return
        with store.open_input_stream(f"{root}/{p.file.removesuffix('.npy')}{INDEX}") as f:
            names = csv.reader(io.TextIOWrapper(f, "utf-8", newline=""))
            next(names, None)
            k = -1
            for k, row in enumerate(names):
                if k >= p.hi and p.hi < p.n:
                    return
                if p.lo <= k < p.hi:
                    yield row[0]
            if k + 1 != p.n:
                raise ValueError(f"{p.file} has {p.n} rows, its index {k + 1}")

    def read(self, p: Rows) -> Iterator[pa.RecordBatch]:
        store, root = open_folder(self.path)
        dtype, width = np.dtype(p.dtype), int(np.prod(p.shape))
        step = max(1, SLAB_BYTES // max(1, dtype.itemsize * width)) if not self.ids else p.hi - p.lo
        names = self.subjects(store, root, p)
        path = f"{root}/{p.file}"
        f = None if self.ids else store.open_input_file(path)
        for lo in range(p.lo, p.hi, step):
            k = min(step, p.hi - lo)
            own = [next(names, None) for _ in range(k)]
            if self.ids:
                shape = values = pa.nulls(k)
            else:
                f.seek(p.begin + lo * width * dtype.itemsize)
                flat = np.frombuffer(f.read(k * width * dtype.itemsize), dtype).astype(np.float32)
                values = pa.ListArray.from_arrays(pa.array(np.arange(k + 1) * width, pa.int32()), pa.array(flat))
                shape = pa.array([list(p.shape)] * k, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([path] * k), pa.array([p.tensor] * k), pa.array(np.arange(k) + p.first + lo - p.lo, pa.int64()), pa.array(own, pa.string()), shape.cast(pa.list_(pa.int32())), values.cast(pa.list_(pa.float32()))],
                names=["path", "tensor", "row_idx", "subject_id", "shape", "values"],
            )
        next(names, None)  # checks the index after the last row
        if f:
            f.close()


@dataclass
class Written(WriterCommitMessage):
    files: list


class ArrayWriter(DataSourceArrowWriter):
    """Rows come by tensor and number; a part ends with its tensor, its shape, the part that its rows were in before, or FILE_BYTES."""

    def __init__(self, options, overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.most, self.replaced = int(options.get("filebytes", FILE_BYTES)), json.loads(options.get("replaced", "[]"))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, root = open_folder(self.path)
        done, held, key, size = [], [], None, 0

        def flush():
            if held:
                tensor, shape, _ = key
                name = f"{tensor}-{uuid.uuid4().hex}"
                store.create_dir(f"{root}/{name}".rsplit("/", 1)[0], recursive=True)
                with store.open_output_stream(f"{root}/{name}.npy") as f:
                    np.lib.format.write_array_header_1_0(f, {"descr": "<f4", "fortran_order": False, "shape": (len(held), *shape)})
                    for _, _, values in held:
                        f.write(values.tobytes())
                with store.open_output_stream(f"{root}/{name}{INDEX}") as f:
                    text = io.StringIO()
                    csv.writer(text, lineterminator="\n").writerows([["participant_id"], *([s] for _, s, _ in held)])
                    f.write(text.getvalue().encode())
                done.append({"file": f"{name}.npy", "tensor": tensor, "at": held[0][0], "n": len(held)})
                held.clear()

        for batch in iterator:
            columns = (batch.column(c).to_pylist() for c in ("tensor", "row_idx", "subject_id", "shape", "before"))
            for k, (tensor, row, subject, shape, before) in enumerate(zip(*columns, strict=True)):
                values = batch.column("values")[k].values.to_numpy(zero_copy_only=False).astype("<f4")
                if (tensor, tuple(shape), before) != key or size + values.nbytes > self.most:
                    flush()
                    key, size = (tensor, tuple(shape), before), 0
                held.append((row, subject, values))
                size += values.nbytes
        flush()
        return Written(done)

    def commit(self, messages) -> None:
        publish(*open_folder(self.path), [p for m in messages if m for p in m.files], self.replaced, self.overwrite)

    def abort(self, messages) -> None:
        store, root = open_folder(self.path)
        for p in [p for m in messages if m for p in m.files]:
            store.delete_file(f"{root}/{p['file']}")


class Arrays(DataSource):
    @classmethod
    def name(cls) -> str:
        return "npy"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ArrayReader:
        return ArrayReader(self.options)

    def writer(self, schema, overwrite: bool) -> ArrayWriter:
        return ArrayWriter(self.options, overwrite)


def read_tensors(spark: SparkSession, path: str, partition_bytes: int = PARTITION_BYTES, files: list[str] | None = None, ids_only: bool = False) -> DataFrame:
    """(path, tensor, row_idx, subject_id, shape, values) of all tensors of a folder, a task for each range of rows; with `ids_only` the arrays aren't read, shape and values are null.

    `files` names parts, relative to the folder. A tensor without an index has null subjects; one whose index has another number of rows is an error.
    """
    spark.dataSource.register(Arrays)
    own = spark.read.format("npy").option("partitionbytes", partition_bytes).option("ids", str(ids_only).lower())
    return (own if files is None else own.option("files", json.dumps(files))).load(path)


def write_tensors(rows: DataFrame, path: str, mode: str = "overwrite", file_bytes: int = FILE_BYTES, replaced: list[str] | None = None) -> None:
    """Writes (tensor, row_idx, subject_id, shape, values), whatever order they come in, as parts of at most `file_bytes`. `append` adds rows behind those of a tensor, or puts them in the place of the parts `replaced`, which a column path then names."""
    spark = rows.sparkSession
    spark.dataSource.register(Arrays)
    # rows of different parts stay apart, as other parts may lie between them
    before = F.col("path") if replaced else F.lit(None).cast("string")
    own = rows.select("tensor", F.col("row_idx").cast("long"), "subject_id", F.col("shape").cast("array<int>"), F.col("values").cast("array<float>"), before.alias("before"))
    dealt = own.repartitionByRange("tensor", "row_idx").sortWithinPartitions("tensor", "row_idx")
    dealt.write.format("npy").mode(mode).option("filebytes", file_bytes).option("replaced", json.dumps(replaced or [])).save(path)


def clean(path: str) -> int:
    """Deletes parts, and drafts of manifests, that the newest manifest doesn't list: replaced ones, and what a failed write has left. How many."""
    store, root = open_folder(path)
    known = versions(store, root)
    if not known:
        return 0
    valid = {f"{root}/{p['file']}" for p in parts(store, root)}
    valid |= {f.removesuffix(".npy") + INDEX for f in valid} | {f"{root}/{MANIFEST}/{v:08d}.json" for v in known}
    stray = [f.path for f in store.get_file_info(fs.FileSelector(root, recursive=True)) if f.is_file and f.path not in valid]
    for f in stray:
        store.delete_file(f)
    return len(stray)


def erase_subjects(spark: SparkSession, path: str, subjects: DataFrame, dry_run: bool = False, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Removes the rows of the subjects (subject_id) from all tensors of a folder and numbers the rest anew: (file, tensor, n_rows, n_removed) of the parts that held one.

    Indices alone tell which parts these are; they are written anew without the subjects, the next manifest takes them in the place of the old ones, and only then
    are those deleted. Other parts aren't read. A run that failed on the way, or that is repeated, is made good by the next: it finds what is left to remove, and
    deletes files that no manifest lists. A dry run only reports.
    """
    store, root = open_folder(path)
    if not versions(store, root):
        raise ValueError(f"{path} has no manifest")
    gone = subjects.select("subject_id").distinct()
    ids = read_tensors(spark, path, ids_only=True).join(gone.withColumn("gone", F.lit(True)), "subject_id", "left")
    held = ids.groupBy(F.substring("path", F.lit(len(root) + 2), F.length("path")).alias("file"), "tensor").agg(F.count("*").alias("n_rows"), F.count_if("gone").alias("n_removed")).where("n_removed > 0")
    found = held.collect()  # as many as there are parts in the manifest, at most
    if not dry_run:
        if files := [r.file for r in found]:
            write_tensors(read_tensors(spark, path, files=files).join(gone, "subject_id", "left_anti"), path, "append", file_bytes, files)
        clean(path)
    return spark.createDataFrame(found, held.schema)
