"""Packing of groups with many short pieces, and the two packings against each other."""

import math

import numpy as np

from periodgrid.llm import packing


def test_many_pieces_of_one_token_are_packed():
    lengths = np.concatenate([np.ones(11000, np.int64), np.full(5, 700), np.full(3, 1023)])
    bins, places = packing.complete_bins(lengths)
    assert np.bincount(bins, lengths).max() <= packing.CAPACITY
    assert bins.max() + 1 == math.ceil(lengths.sum() / packing.CAPACITY)
    for held in range(bins.max() + 1):
        mine = np.flatnonzero(bins == held)
        mine = mine[np.argsort(places[mine])]
        assert (places[mine] == np.cumsum(lengths[mine]) - lengths[mine]).all()


def test_no_group_takes_more_bins_than_best_fit(monkeypatch):
    rng = np.random.default_rng(5)
    monkeypatch.setattr(packing, "NODES", 1)  # bin completion is poor, best fit is not
    for _ in range(40):
        lengths = rng.integers(1, 600, 60)
        best = packing.best_fit(lengths)
        assert np.bincount(best[0], lengths).max() <= packing.CAPACITY
        assert packing.complete_bins(lengths)[0].max() <= best[0].max()
