"""What language-model scoring brings to the driver."""

import numpy as np
from pyspark.sql import functions as F

from reelhouse.llm import lm_score


def test_candidates_are_bounded_whatever_the_number_of_blocks(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "HOT", 20)
    # Each text is a block of its own few words; two words are frequent everywhere, one of them in part of the blocks alone.
    rows = [(i, i % 3 != 0, " ".join(["every"] * 5 + ["half"] * (6 * (i % 2)) + [f"w{i}x{k % 3}" for k in range(12)])) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, train boolean, text string").repartition(300)
    blocks = lm_score.blocks_of(docs.select("doc_id", "train", F.col("text").cast("binary").alias("text"))).persist()
    trained = blocks.agg(F.sum("trained")).first()[0]
    words, counts = lm_score.hot_words(blocks, trained)
    tokens = [w for _, train, t in rows if train for w in [*t.split(), " end"]]
    import xxhash

    want = {xxhash.xxh3_64_intdigest(w.encode()): tokens.count(w) for w in set(tokens) if tokens.count(w) * 20 > len(tokens)}
    assert dict(zip(words.tolist(), counts.tolist())) == want and len(want) == 2
    told = blocks.select(F.explode("often")).distinct().count()
    assert told > 300  # words that some block tells
    assert np.all(words[:-1] < words[1:])
    blocks.unpersist()
