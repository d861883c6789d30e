"""Sizes that prune paragraph pairs are those of the verified sets."""

import pyarrow as pa

from ledgerscope.llm import paragraphs


def test_distinct_grams_of_repeating_paragraphs():
    words = [w for w in (f"r{i}a" for i in range(400)) if __import__("xxhash").xxh3_64_intdigest(w) % paragraphs.CUT][:20]
    texts = [" ".join(words * 3), " ".join(words * 2), "a b c d e f g h", "a b", None]
    units = paragraphs.Units(pa.array(texts, pa.string()))
    assert units.distinct().tolist() == [max(1, len(units.grams(u))) for u in range(len(units.count))]
    assert units.count[:2].tolist() == [60, 40] and units.distinct()[:2].tolist() == [20, 20]
