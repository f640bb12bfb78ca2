import math
import os
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry import sources as S
from quarry.functions import scalar as L
from quarry.operators import shaping as P


def test_split_is_deterministic_and_complete(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    a = {r.k: r.split for r in P.split_column(df, [0.7, 0.3], "k", seed=1).collect()}
    b = {r.k: r.split for r in P.split_column(df.repartition(7), [0.7, 0.3], "k", seed=1).collect()}
    assert a == b and len(a) == 2000
    share = sum(1 for v in a.values() if v == 0) / 2000
    assert 0.65 < share < 0.75
    parts = P.split_rows(df, [0.5, 0.3, 0.2], "k")
    assert sum(p.count() for p in parts) == 2000


def test_global_index_and_quantiles(spark):
    rng = np.random.default_rng(0)
    vals = rng.integers(0, 50, 500).tolist()
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    probs = [0.0, 0.1, 0.5, 0.9, 1.0]
    got = {r.p: r.value for r in P.exact_quantiles(df, "x", probs).collect()}
    s = sorted(vals)
    for p in probs:
        assert got[p] == s[max(1, math.ceil(p * len(s))) - 1]
    # equals Spark's exact approxQuantile
    assert [got[p] for p in probs] == df.stat.approxQuantile("x", probs, 0.0)
    idx = P.global_index(spark.createDataFrame([(i,) for i in rng.permutation(300).tolist()], "v long"), ["v"])
    assert all(r["index"] == r.v for r in idx.collect())


def test_label_frequency_ties_and_topk(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "v string")
    rows = sorted((r["index"], r.value, r["count"]) for r in P.label_frequency(df, "v").collect())
    assert rows == [(0, "c", 2), (1, "a", 1), (2, "b", 1)]
    t = spark.createDataFrame([(1, 5.0), (1, 3.0), (1, 4.0), (2, 1.0)], "g int, x double")
    top = P.top_k_per_group(t, ["g"], [F.desc("x")], 2)
    assert sorted((r.g, r.x, r["rank"]) for r in top.collect()) == [(1, 4.0, 2), (1, 5.0, 1), (2, 1.0, 1)]


def test_drop_columns_case_insensitive(spark):
    df = spark.createDataFrame([(1, 2, 3)], "CustomerId int, b int, c int")
    assert P.drop_columns(df, "customerid", "B").columns == ["c"]


def test_scalar_helpers(spark):
    df = spark.createDataFrame([("1::2::x", "8/6/2013 14:05", "RED  HEART ")], "s string, t string, d string")
    r = df.select(
        L.array_element(L.split_regex("s", "::"), 1).alias("second"),
        L.array_element(L.split_regex("s", "::"), 9).alias("missing"),
        L.safe_cast(L.array_element(L.split_regex("s", "::"), 2), "int").alias("bad"),
        L.epoch_seconds(L.parse_timestamp("t")).alias("ep"),
        L.parse_timestamp(F.lit("13/45/2013 99:99")).alias("junk"),
        L.whitespace_tokens("d").alias("tok"),
        L.ratio(F.lit(1), F.lit(0)).alias("div0"),
    ).first()
    assert r.second == "2" and r.missing is None and r.bad is None and r.junk is None and r.div0 is None
    assert r.ep == 1375797900
    assert r.tok == ["red", "", "heart", ""]  # SQL split keeps trailing empties


def test_read_csv_quoted_and_json(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "a.csv")
    with open(p, "w") as f:
        f.write('DEST,ORIGIN,count\n"Arden, Little Brook",Northland,17\nQuell,Marsh,3\n')
    df = S.read_csv(spark, p, schema="DEST string, ORIGIN string, count long")
    assert sorted(tuple(r) for r in df.collect()) == [("Arden, Little Brook", "Northland", 17), ("Quell", "Marsh", 3)]
    inferred = S.read_csv(spark, p, infer=True)
    assert dict(inferred.dtypes)["count"] == "int"
    j = os.path.join(tmpdir_path, "j")
    os.makedirs(j)
    with open(os.path.join(j, "part-0.json"), "w") as f:
        f.write('{"lab":"good","value1":8,"value2":1.5}\n')
    assert dict(S.read_json(spark, j).dtypes) == {"lab": "string", "value1": "bigint", "value2": "double"}


def test_read_delimited_strict_and_lenient(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "r.txt")
    with open(p, "w") as f:
        f.write("7::41::2::1300000000\n8::9\n")
    fields = [("userId", "int"), ("movieId", "int"), ("rating", "float"), ("timestamp", "long")]
    rows = S.read_delimited(spark, p, fields).orderBy("userId").collect()
    assert tuple(rows[0]) == (7, 41, 2.0, 1300000000) and rows[1].rating is None
    with pytest.raises(Exception):
        S.read_delimited(spark, p, fields, strict=True).collect()


def test_headerless_routes_and_hidden_files(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "hive")
    os.makedirs(d)
    with open(os.path.join(d, "part-00000-c000"), "w") as f:
        f.write("Arden, Little Brook, and Vale,Northland,17\nNorthland,Quell,4\n")
    with open(os.path.join(d, "_committed_123"), "w") as f:
        f.write('{"added":["part-00000-c000"]}\n')
    rows = sorted(tuple(r) for r in S.read_headerless_routes(spark, d).collect())
    assert rows == [("Arden, Little Brook, and Vale", "Northland", 17), ("Northland", "Quell", 4)]


def test_read_yearly(spark, tmpdir_path):
    for year in (2010, 2011):
        d = os.path.join(tmpdir_path, "csv")
        os.makedirs(d, exist_ok=True)
        with open(os.path.join(d, f"{year}-summary.csv"), "w") as f:
            f.write(f"DEST,ORIGIN,count\nA,B,{year}\n")
    df = S.read_yearly(spark, os.path.join(tmpdir_path, "csv"), schema="DEST string, ORIGIN string, count long")
    assert sorted((r.year, r["count"]) for r in df.collect()) == [(2010, 2010), (2011, 2011)]


def _png(w, h, rgb):
    raw = b"".join(b"\x00" + bytes(rgb) * w for _ in range(h))

    def chunk(tag, data):
        return struct.pack(">I", len(data)) + tag + data + struct.pack(">I", zlib.crc32(tag + data) & 0xFFFFFFFF)

    ihdr = struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", ihdr) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def test_read_images_labels_from_folder(spark, tmpdir_path):
    for label, rgb in (("tulips", (10, 20, 30)), ("daisy", (200, 100, 50))):
        os.makedirs(os.path.join(tmpdir_path, label))
        with open(os.path.join(tmpdir_path, label, "x.png"), "wb") as f:
            f.write(_png(3, 2, rgb))
    df = S.read_images(spark, tmpdir_path)
    rows = {r.label: r.image for r in df.collect()}
    assert set(rows) == {"tulips", "daisy"}
    img = rows["tulips"]
    assert (img.width, img.height, img.nChannels) == (3, 2, 3)
    assert tuple(img.data[:3]) == (30, 20, 10)  # BGR


def test_write_table_and_model_roundtrip(spark, tmpdir_path):
    from pyspark.ml.feature import StandardScaler, StandardScalerModel
    from pyspark.ml.linalg import Vectors

    df = spark.createDataFrame([(Vectors.dense([1.0, 2.0]),), (Vectors.dense([3.0, 5.0]),)], ["features"])
    path = S.write_table(df.select(F.lit(1).alias("x")), os.path.join(tmpdir_path, "t"))
    assert spark.read.parquet(path).count() == 2
    m = StandardScaler(inputCol="features", outputCol="s").fit(df)
    S.save_model(m, os.path.join(tmpdir_path, "m"))
    m2 = S.load_model(StandardScalerModel, os.path.join(tmpdir_path, "m"))
    assert m2.std == m.std


def test_cluster_conf_sizes_partitions():
    from quarry.session import cluster_conf

    conf = cluster_conf(100 * (1 << 40), 8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 409600
    assert cluster_conf(1 << 20, 8)["spark.sql.shuffle.partitions"] == "16"


def test_lead_within_hot_group_matches_window(spark):
    from pyspark.sql import Window

    rows = [(0, i, i * 7 % 13) for i in range(300)] + [(g, i, g + i) for g in range(1, 20) for i in range(3)]
    df = spark.createDataFrame(rows, "g int, o int, v int")
    got = {(r.g, r.o): r["next"] for r in P.lead_within(df, ["g"], ["o"], "v").collect()}
    w = Window.partitionBy("g").orderBy("o")
    ref = {(r.g, r.o): r["next"] for r in df.select("g", "o", F.lead("v").over(w).alias("next")).collect()}
    assert got == ref


def test_vector_entries_sparse_and_dense(spark):
    from pyspark.ml.linalg import Vectors

    from quarry.operators import features as FE

    df = spark.createDataFrame([(0, Vectors.sparse(6, [1, 4], [2.0, 0.0])), (1, Vectors.dense([0.0, 3.0]))],
                               ["k", "v"])
    rows = sorted(tuple(r) for r in FE.explode_vector(df, ["k"], "v", nonzero=True).collect())
    assert rows == [(0, 1, 2.0), (1, 1, 3.0)]
    wide = spark.createDataFrame([(2, Vectors.sparse(1 << 20, [5, 999_999], [1.0, 4.0]))], ["k", "v"])
    rows = sorted(tuple(r) for r in FE.explode_vector(wide, ["k"], "v", nonzero=True).collect())
    assert rows == [(2, 5, 1.0), (2, 999_999, 4.0)]


def test_read_yearly_mixed_csv_and_json(spark, tmpdir_path):
    csv_dir, json_dir = os.path.join(tmpdir_path, "csv"), os.path.join(tmpdir_path, "json")
    os.makedirs(csv_dir)
    os.makedirs(json_dir)
    with open(os.path.join(csv_dir, "2014-summary.csv"), "w") as f:
        f.write('DEST_COUNTRY_NAME,ORIGIN_COUNTRY_NAME,count\n"Arden, Little Brook, and Vale",Northland,29\n')
    with open(os.path.join(json_dir, "2015-summary.json"), "w") as f:
        f.write('{"ORIGIN_COUNTRY_NAME":"Marsh","DEST_COUNTRY_NAME":"Northland","count":6}\n')
    schema = "DEST_COUNTRY_NAME string, ORIGIN_COUNTRY_NAME string, count long"
    df = S.read_yearly_mixed(spark, [("csv", csv_dir), ("json", json_dir)], schema)
    rows = sorted((r.year, r.DEST_COUNTRY_NAME, r["count"]) for r in df.collect())
    assert rows == [(2014, "Arden, Little Brook, and Vale", 29), (2015, "Northland", 6)]


def test_read_binary(spark, tmpdir_path):
    with open(os.path.join(tmpdir_path, "a.bin"), "wb") as f:
        f.write(b"\x00\x01\x02")
    with open(os.path.join(tmpdir_path, "b.txt"), "w") as f:
        f.write("x")
    rows = S.read_binary(spark, tmpdir_path, "*.bin").collect()
    assert len(rows) == 1 and bytes(rows[0].content) == b"\x00\x01\x02" and rows[0].length == 3


def test_scratch_dir_uses_session_checkpoint_dir(spark):
    from quarry.session import scratch_dir, stage_path

    preset = spark.conf.get("spark.checkpoint.dir")  # conftest sets it
    assert scratch_dir(spark) == scratch_dir(spark) == preset
    assert stage_path(spark, "x") == f"{preset}/stage/x"


class _Session:
    """What scratch_dir asks of a session."""

    def __init__(self, master, conf=None):
        self.sparkContext = self
        self.master, self.applicationId, self.conf, self.set = master, f"app-{master}-{conf}", self, None
        self.named = conf

    def get(self, key, default=None):
        return self.named if self.named else default

    def getConf(self):
        return self

    def getCheckpointDir(self):
        return self.set

    def setCheckpointDir(self, path):
        self.set = path


def test_scratch_dir_refuses_a_cluster_without_a_shared_folder():
    from quarry.session import scratch_dir

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(_Session("spark://host:7077"))
    local = _Session("local[2]")
    assert scratch_dir(local) == scratch_dir(local) == local.set
    named = _Session("yarn", "hdfs://name/shared/")
    assert scratch_dir(named) == "hdfs://name/shared" and named.set == "hdfs://name/shared/"


def test_small_splits_are_not_empty(spark):
    df = spark.range(100_000).withColumnRenamed("id", "k")
    big, small = P.split_rows(df, [0.999, 0.001], "k")
    assert 50 <= small.count() <= 160 and big.count() + small.count() == 100_000
    many = P.split_column(df, [1] * 200, "k").groupBy("split").count().collect()
    assert len(many) == 200


def test_more_than_a_hundred_folds(spark):
    from quarry.operators import tuning as T

    folds = T.fold_column(spark.range(20_000).withColumnRenamed("id", "k"), "k", 250).groupBy("fold").count()
    assert folds.count() == 250
