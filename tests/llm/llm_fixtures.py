"""Fixtures of the tests in this folder, which import them."""

import pytest

from spendlens.llm.common import ship_package

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def llm(spark):
    ship_package(spark)
    return spark


@pytest.fixture(scope="session")
def words():
    """Deterministic texts of n words from a small vocabulary."""

    def make(seed, n, vocabulary=400):
        out, x = [], seed * 7919 + 17
        for _ in range(n):
            x = (x * 1103515245 + 12345) % (1 << 31)
            out.append(f"w{(x >> 8) % vocabulary}")
        return " ".join(out)

    return make
