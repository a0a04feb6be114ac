"""What the blocks of op1 and their buckets send each other takes little room."""

import numpy as np
import pytest

from fieldgauge.llm import katz


def test_rising_numbers_are_sent_as_steps():
    rng = np.random.default_rng(1)
    ids = np.sort(rng.choice(1 << 24, 100_000, replace=False))
    mixed = np.concatenate([ids[::2], ids[1::2], [1, 0, 0]])
    for x in (ids, mixed, mixed[:1], mixed[:0]):
        assert np.array_equal(katz.walked(katz.get(katz.put(katz.steps(x)))), x)
    assert 1.1 * len(katz.put(katz.steps(ids))) < len(katz.put(ids))


@pytest.mark.parametrize("one_hash", [False, True])
def test_equal_histories_share_a_number(monkeypatch, one_hash):
    rng = np.random.default_rng(2)
    columns = rng.zipf(1.6, (11, 3000)) % 4
    columns[:, 1000:2000] = columns[:, [5]]
    if one_hash:
        monkeypatch.setattr(katz.W, "mix", np.zeros_like)
    number, kinds = katz._kinds(columns)
    assert np.array_equal(kinds[:, number], columns)
    assert kinds.shape == np.unique(columns, axis=1).shape
    assert number[5] == 0


def test_numbers_of_every_size_come_back():
    for top in (1, 255, 256, 65_535, 1 << 20, 1 << 33, 1 << 62):
        x = np.array([0, top, 1, top - 1])
        assert np.array_equal(katz.get(katz.put(x)), x)
    x = np.array([0, 1 << 63, (1 << 64) - 1], np.uint64)
    assert np.array_equal(katz.get(katz.put(x)), x) and katz.get(katz.put(x)).dtype == np.uint64
