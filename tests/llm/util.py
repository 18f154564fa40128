"""Small tables with the awkward rows every operator must survive."""

import random

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


def docs(spark, rows, **extra):
    """rows: (doc_id, text) or (doc_id, text, source)."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
    df = spark.createDataFrame(full, DOCS)
    for name, value in extra.items():
        from pyspark.sql import functions as F
        df = df.withColumn(name, F.lit(value))
    return df


def words(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(["alpha", "beta,", "gamma.", "delta", "épsilon", "zeta!", "eta", "theta?"]) +
                    str(rng.randrange(50)) for _ in range(n))


def awkward(seed: int = 7):
    """Null, empty, blank, very long, repeated and tied rows; a null id; other scripts."""
    rng = random.Random(seed)
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, words(rng, 30_000)), (6, "same text here twice over"),
            (7, "same text here twice over"), (8, "same text here twice over"), (8, "same text here twice over"),
            (9, "日本語 テキスト 🎉 é"), (None, "no id"), (10, "x" * 5000)]
    rows += [(100 + i, words(rng, rng.randrange(1, 60)), f"s{i % 3}") for i in range(60)]
    return rows


def cores_come_and_go(monkeypatch, spark, module, name):
    """Each call of ``module.name`` changes the parallelism by which Spark packs
    files into partitions, as executors that are lost and return do."""
    real, calls = getattr(module, name), [0]

    def call(*args, **kwargs):
        out = real(*args, **kwargs)
        calls[0] += 1
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", (1, 64, 3)[calls[0] % 3])
        return out
    monkeypatch.setattr(module, name, call)


def files(spark, rows):
    """``rows`` as a Parquet table of many files."""
    from signalyard.llm.common import shared_path
    path = shared_path(spark, "files")
    docs(spark, rows).repartition(24, "doc_id").write.parquet(path)
    return spark.read.parquet(path)
