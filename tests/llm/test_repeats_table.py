import numpy as np

from doccairn.llm import repeats


def grams_of(seed, size):
    body = np.random.default_rng(seed).integers(0, 256, size).astype(np.uint8)
    return np.concatenate([grams for _, _, grams, _, _ in repeats.runs(body)])


def test_few_grams_pass_a_table_of_others():
    """Grams are least hashes; as they are, they would share a hundredth of the table."""
    table = np.zeros(1 << (repeats.TABLE_BITS - 6), dtype=np.uint64)
    known = grams_of(1, 3_000_000)
    place = known >> np.uint64(64 - repeats.TABLE_BITS)
    np.bitwise_or.at(table, (place >> np.uint64(6)).astype(np.int64), np.uint64(1) << (place & np.uint64(63)))
    assert repeats._passes(table, known).all()
    assert repeats._passes(table, grams_of(2, 1_000_000)).mean() < 0.005
