"""Toxicity: the counts of the positive class cover all positives, not the sample that the weights are fitted on."""

import random
import zlib

from pyspark.sql import functions as F

from hiremart.llm import toxicity as T


def test_a_word_of_unsampled_positives_becomes_a_feature(spark, documents):
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefgh", k=5))
    ids = spark.range(600).select(F.col("id").alias("k")).where(T.learnable("k") & (F.col("k") % 3 == 0))
    positive = [r.k for r in ids.orderBy(F.xxhash64("k"), "k").collect()]
    sampled = set(positive[:20])
    known = set(positive)

    def text(k):
        mark = ["zzzbad"] if k in sampled else ["qqqrare"] if k in known else []
        return " ".join([word() for _ in range(20)] + mark)

    docs = documents([(k, text(k)) for k in range(600)])
    told = spark.createDataFrame([(k, int(k in known)) for k in range(600)], "doc_id long, toxic int")
    of = lambda w: zlib.crc32(f"={w}".encode()) % T.BINS
    try:
        for rows in (None, "1"):  # ids broadcast, then joined by shuffle
            if rows:
                spark.conf.set("hiremart.broadcast.maxRows", rows)
            model = T.train(docs, told, max_positives=20)
            assert of("qqqrare") in model.bins and of("zzzbad") in model.bins
    finally:
        spark.conf.unset("hiremart.broadcast.maxRows")
    assert model.weights[model.bins.tolist().index(of("zzzbad"))] > 0
