"""Fingerprints in the pipeline's near-dedup stage."""

import corpus_pipeline
from acopio.llm import shingles, simhash


def _alike(a, b):
    return shingles.alike(shingles.shingles(a), shingles.shingles(b))


def test_pipeline_links_fingerprints(spark):
    """Texts within three bits are near copies also below four fifths of their shingles, and lead on to banded ones."""
    words = [f"w{i}" for i in range(40)]
    base = " ".join(words)
    others = (" ".join([*words[:i], f"n{k}", *words[i + 1 :]]) for i in range(5, 35) for k in range(400))
    bits = lambda t: simhash.simhash(t, 5) & (2**64 - 1)
    near = next(t for t in others if (bits(base) ^ bits(t)).bit_count() <= 3 and not _alike(base, t))
    chained = f"first {near}"
    assert _alike(near, chained) and not _alike(base, chained)
    rows = [(3, base), (1, near), (2, chained), (4, "some other text of a few words"), (5, None), (6, "")]
    docs = spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id long, text string, source string")
    kept = corpus_pipeline.drop_near_copies(spark, docs, "").collect()
    assert sorted(r["doc_id"] for r in kept) == [1, 4, 5]
