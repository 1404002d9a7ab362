"""Chances near 0 and 1 in the stored model."""

import math

import numpy as np
import pytest

from mailsift.llm import ctw


def test_certain_nodes_leave_a_chance_to_the_other_bit():
    keys = np.sort(np.array([ctw.node_key(0, np.int64(1 << b | 255 >> (8 - b))) for b in range(8)]))
    (batch,) = ctw._rows(2, keys, np.full(8, 1 - 1e-9), None)
    nodes, chances = batch.column("key").to_numpy(), batch.column("value").to_numpy()
    block = ctw.Block(0, 1, np.zeros(0, np.int64), np.zeros(0), nodes, chances)
    ones, then_zero = block.logs(np.array([0x0102030405FF, 0x0102030405FE], np.int64))
    assert ones == pytest.approx(-8e-9, rel=1e-3)
    assert then_zero == pytest.approx(math.log(1e-9), rel=1e-3)
