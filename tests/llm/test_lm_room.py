"""The room that the language model's rows take between its steps."""

import numpy as np
import pyarrow as pa
import pytest

from fieldweave.llm import lm, wordlm


@pytest.mark.parametrize("values", [[], [0], [255, 256], [7] * 5_000, [2**64 - 1, 0, 2**63], list(range(0, 10**6, 7))])
def test_packed_numbers_come_back(values):
    values = np.array(values, np.uint64)
    assert lm.unpack(lm.pack(values), np.uint64).tolist() == values.tolist()
    assert lm.unpack_rising(lm.pack_rising(values)).tolist() == values.tolist()


def test_sums_come_back():
    docs, values = np.array([5, 2, 5, 900]), np.array([[-1.5, -2.25, 1], [-0.1, -7, 0], [-1e-9, -3, 1], [0, 0, 0]])
    texts, sums = lm._summed(docs, values)
    assert lm.unpack_rising(texts).tolist() == [2, 5, 900]
    assert lm.unpack(sums, np.uint64).view(np.float64).reshape(3, -1).T.tolist() == [[-0.1, -7, 0], [-1.5 - 1e-9, -5.25, 2], [0, 0, 0]]


def test_room_of_what_texts_ask(spark):
    """Bytes for each token, as Spark compresses them, of what the texts ask of the shards. Hashes were sent whole, and small
    numbers as bytes of which Spark's codec finds only those that are repeated."""
    random = np.random.default_rng(3)
    sizes = np.minimum(random.zipf(1.5, 400) * 40, 8_000)
    texts = [(i, " ".join(f"w{int(x)}" for x in np.minimum(random.zipf(1.2, n), 10**7))) for i, n in enumerate(sizes.tolist())]
    docs = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    asked = ", ".join(f"{n} binary" for n in wordlm._ASKED)
    rows = lm._prepared(docs, lm.in_training()).mapInArrow(
        wordlm._probe_rows(wordlm.Settings(), 4), f"chunk long, shard long, {asked}, ids array<long>, held_out array<boolean>, n_tokens array<long>"
    )
    blobs = [[b for b in (r[n] for n in wordlm._ASKED) if b is not None] for r in rows.collect()]
    room = sum(len(pa.compress(b"".join(x), "lz4", asbytes=True)) for x in blobs if x)
    tokens = sum(sizes.tolist()) + len(sizes)
    print(f"{room / tokens:.2f} bytes a token")
    assert room < 5 * tokens
