"""Writing derived data to the shared scratch folder so file sources can be
checked against tables they were derived from."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import stage_path
from quarry.sources.files import write_table

#: Images of a batch: as many files as one read lists on the driver.
IMAGES = 50_000


def stage(spark: SparkSession, sf_dir: str, name: str, df: DataFrame, fmt: str, **options) -> str:
    """Write ``df`` under ``<checkpoint dir>/stage/<name>-<sf hash>`` and return the path."""
    tag = hashlib.md5(sf_dir.encode()).hexdigest()[:8]
    path = stage_path(spark, f"{name}-{tag}")
    partition_by = options.pop("partition_by", None)
    return write_table(df, path, fmt=fmt, partition_by=partition_by, **options)


def as_uri(spark: SparkSession, path: str) -> str:
    """``path`` as a URI: a path without a scheme lies in the file system that Spark's own readers take it from."""
    if path.startswith("file:"):
        return "file://" + path.removeprefix("file:").removeprefix("//")
    if ":" in path.split("/")[0]:
        return path
    store = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
    return store.rstrip("/") + path if not store.startswith("file:") else "file://" + path


def stage_embedding_images(
    spark: SparkSession, sf_dir: str, embeddings: DataFrame, side: int = 8, batch: int = IMAGES
) -> list[str]:
    """Render each embedding row as a ``side`` x ``side`` grayscale PNG
    ``<stage>/images/batch_<n>/label_<label>/<vec_id>.png`` (one folder per
    class) and return the folders of the batches.

    Rows are dealt by a hash of ``vec_id`` into batches of about ``batch``
    images, so that a reader can list one batch after the other: Spark's driver
    holds a record of every file of a read.

    Pixel ``i`` is ``clamp(floor((x_i + 1) * 127.5), 0, 255)`` of its
    ``side * side`` values; vectors of another length are refused.  Files are written by the tasks themselves
    (``mapInPandas``), so the rendering is partitioned like the table; a
    retried task rewrites the same file names.
    """
    tag = hashlib.md5(sf_dir.encode()).hexdigest()[:8]
    root = stage_path(spark, f"images-{tag}-{uuid.uuid4().hex}")
    uri = as_uri(spark, root)
    batches_wanted = max(1, -(-embeddings.count() // batch))
    n = side * side

    # The task function is self-contained (stdlib, numpy, pandas, pyarrow only),
    # so executors need not import this package.
    def write(batches):
        import struct
        import zlib

        import numpy as np
        import pandas as pd
        from pyarrow import fs as pafs

        def _png_gray(width: int, height: int, pixels: bytes) -> bytes:
            """Encode 8-bit grayscale pixels (row-major) as a PNG file."""
            raw = b"".join(b"\x00" + pixels[r * width:(r + 1) * width] for r in range(height))

            def chunk(tag: bytes, data: bytes) -> bytes:
                crc = zlib.crc32(tag + data) & 0xFFFFFFFF
                return struct.pack(">I", len(data)) + tag + data + struct.pack(">I", crc)

            header = struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0)
            return (b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", header) + chunk(b"IDAT", zlib.compress(raw))
                    + chunk(b"IEND", b""))

        filesystem, base = pafs.FileSystem.from_uri(uri)
        for pdf in batches:
            for number, label in pdf[["batch", "label"]].drop_duplicates().itertuples(index=False):
                filesystem.create_dir(f"{base}/batch_{int(number)}/label_{int(label)}", recursive=True)
            for number, vec_id, label, emb in zip(pdf["batch"], pdf["vec_id"], pdf["label"], pdf["embedding"]):
                x = np.asarray(emb, dtype=np.float32).astype(np.float64)
                if len(x) != n:
                    raise ValueError(f"vector {vec_id} has {len(x)} values; an image of side {side} needs {n}")
                px = np.clip(np.floor((x + 1.0) * 127.5), 0, 255).astype(np.uint8).tobytes()
                folder = f"{base}/batch_{int(number)}/label_{int(label)}"
                with filesystem.open_output_stream(f"{folder}/{int(vec_id)}.png") as f:
                    f.write(_png_gray(side, side, px))
            yield pd.DataFrame({"written": [len(pdf)]})

    number = F.pmod(F.xxhash64("vec_id"), F.lit(batches_wanted)).cast("int").alias("batch")
    rows = embeddings.select(number, "vec_id", "label", "embedding")
    made = rows.select("batch").distinct().orderBy("batch").collect()
    rows.mapInPandas(write, "written long").agg({"written": "sum"}).collect()
    return [f"{root}/batch_{r['batch']}" for r in made]
