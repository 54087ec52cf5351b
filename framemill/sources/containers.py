"""Frames out of container files: npy dictionaries, pickled lists, zarr chunks, video clips.

Each file, or chunk, is one row of Spark's binaryFile source and is opened in a task.
"""

from __future__ import annotations

import io
import json
import pickle
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FRAME = "path string, frame_idx int, height int, width int, channels int, pixels binary"


def _files(spark: SparkSession, root: str, glob: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root).select("path", "content")


def _text(spark: SparkSession, path: str) -> str:
    """A small file's text; Spark's own sources pass over names that start with a dot."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    stream = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


class _Plain(pickle.Unpickler):
    """Builds arrays, numbers, texts and containers only."""

    ALLOWED = {("numpy", "ndarray"), ("numpy", "dtype"), ("numpy.core.multiarray", "_reconstruct"), ("numpy.core.multiarray", "scalar"), ("numpy._core.multiarray", "_reconstruct"), ("numpy._core.multiarray", "scalar"), ("_codecs", "encode")}

    def find_class(self, module, name):
        if (module, name) not in self.ALLOWED:
            raise pickle.UnpicklingError(f"{module}.{name} is not plain data")
        return super().find_class(module, name)


def _npy_dict(data: bytes):
    f = io.BytesIO(data)
    version = np.lib.format.read_magic(f)
    shape, _, dtype = (np.lib.format.read_array_header_1_0 if version == (1, 0) else np.lib.format.read_array_header_2_0)(f)
    if dtype != object or shape != ():
        return None
    got = _Plain(f).load()
    got = got.item() if isinstance(got, np.ndarray) else got
    return got if isinstance(got, dict) else None


def npy_frames(spark: SparkSession, root: str) -> DataFrame:
    """path, height, width, pixels, f_x, f_y, f_z, grid_z_max, grid_z_mean of npy dictionaries.

    Files without an 8-bit three-dimensional ``gs_img`` are left out. Missing
    forces are 0.0, a missing grid is null.
    """
    schema = "path string, height int, width int, pixels binary, f_x float, f_y float, f_z float, grid_z_max float, grid_z_mean float"
    number = lambda v: float(v) if v is not None else 0.0

    def run(batches):
        for b in batches:
            rows = []
            for path, data in zip(b.column("path").to_pylist(), b.column("content").to_pylist()):
                try:
                    d = _npy_dict(data)
                except Exception:  # damaged files are no frames
                    d = None
                img = None if d is None else d.get("gs_img")
                if not isinstance(img, np.ndarray) or img.dtype != np.uint8 or img.ndim != 3:
                    continue
                grid = d.get("grid_z")
                rows.append((path, img.shape[0], img.shape[1], img.tobytes(), *(number(d.get(k)) for k in ("f_x", "f_y", "f_z")), *((float(np.max(grid)), float(np.mean(grid))) if grid is not None else (None, None))))
            kinds = [pa.string(), pa.int32(), pa.int32(), pa.binary(), *[pa.float32()] * 5]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=[c.split()[0] for c in schema.split(", ")])

    return _files(spark, root, "*.npy").mapInArrow(run, schema)


def pickled_pictures(spark: SparkSession, root: str, skip: str = "org_") -> DataFrame:
    """path, frame_idx, image of pickled lists of encoded pictures; files whose name starts with ``skip`` are left out. Pickles that hold anything but plain data are refused."""
    schema = "path string, frame_idx int, image binary"

    def run(batches):
        for b in batches:
            for path, data in zip(b.column("path").to_pylist(), b.column("content").to_pylist()):
                got = [bytes(x) for x in _Plain(io.BytesIO(data)).load()]
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(got)), pa.array(range(len(got)), pa.int32()), pa.array(got, pa.binary())], names=["path", "frame_idx", "image"])

    f = _files(spark, root, "*.pkl")
    return f.where(~F.element_at(F.split("path", "/"), -1).startswith(skip)).mapInArrow(run, schema)


def zarr_frames(spark: SparkSession, root: str) -> DataFrame:
    """Frames of a zarr (format 2) array cut along its first axis: one task row per chunk. Compression: none, zlib or zstd."""
    meta = json.loads(_text(spark, f"{root}/.zarray"))
    shape, chunk, dtype = meta["shape"], meta["chunks"], np.dtype(meta["dtype"])
    if chunk[1:] != shape[1:] or meta.get("filters"):
        raise ValueError("only arrays that are cut along the first axis, without filters")
    codec = (meta.get("compressor") or {}).get("id")

    def inflate(data: bytes) -> bytes:
        if codec is None:
            return data
        if codec == "zlib":
            return zlib.decompress(data)
        if codec == "zstd":
            import zstandard

            return zstandard.ZstdDecompressor().decompressobj().decompress(data)
        raise ValueError(f"zarr compressor {codec} is not supported")

    def run(batches):
        for b in batches:
            for path, data in zip(b.column("path").to_pylist(), b.column("content").to_pylist()):
                first = int(path.rsplit("/", 1)[-1].split(".")[0]) * chunk[0]
                a = np.frombuffer(inflate(data), dtype).reshape(chunk, order=meta.get("order", "C"))[: max(shape[0] - first, 0)]
                a = a[..., None] if a.ndim == 3 else a
                n = len(a)
                full = lambda v: pa.array(np.full(n, v, np.int32))
                yield pa.RecordBatch.from_arrays([pa.array([path] * n, pa.string()), pa.array(np.arange(first, first + n, dtype=np.int32)), full(a.shape[1]), full(a.shape[2]), full(a.shape[3]), pa.array([x.tobytes() for x in a], pa.binary())], names=[c.split()[0] for c in FRAME.split(", ")])

    return _files(spark, root, "[0-9]*").mapInArrow(run, FRAME)


def video_frames(spark: SparkSession, root: str, glob: str = "*.avi", stride: int = 1) -> DataFrame:
    """Every stride-th frame of every clip; clips that can't be opened are left out. Needs imageio or OpenCV on the executors."""

    def frames(data: bytes):
        try:
            import imageio.v3 as iio

            yield from iio.imiter(data)
        except ImportError:
            try:
                import cv2
            except ImportError as e:
                raise RuntimeError("reading video needs imageio or OpenCV") from e
            import tempfile

            with tempfile.NamedTemporaryFile(suffix=".avi") as f:  # the decoder takes files only; gone when the clip is read
                f.write(data)
                f.flush()
                clip = cv2.VideoCapture(f.name)
                while (got := clip.read())[0]:
                    yield got[1][:, :, ::-1]

    def run(batches):
        for b in batches:
            for path, data in zip(b.column("path").to_pylist(), b.column("content").to_pylist()):
                try:
                    for i, a in enumerate(frames(data)):
                        if i % stride == 0:
                            row = ([path], [i], [a.shape[0]], [a.shape[1]], [a.shape[2]], [np.ascontiguousarray(a).tobytes()])
                            kinds = (pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary())
                            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds)], names=[c.split()[0] for c in FRAME.split(", ")])
                except RuntimeError:
                    raise
                except Exception:  # a bad clip is passed over
                    continue

    return _files(spark, root, glob).mapInArrow(run, FRAME)
