"""Bands of min-max signatures."""

import numpy as np
import pytest

from listingflow.llm.minmax import band_shape, signatures


@pytest.mark.parametrize("threshold", [0.8, 0.85])
def test_no_band_holds_both_values_of_a_permutation(threshold):
    rows, bands = band_shape(threshold)
    # Of a set of one shingle, the least and the greatest value are the same.
    values = signatures([np.array([12345], np.uint64)], -(-rows * bands // 2))[0, : rows * bands].reshape(bands, rows)
    assert all(len(set(band)) == rows for band in values.tolist())
