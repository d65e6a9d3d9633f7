"""The registered queries next to their SQL."""

import pytest
from harness import compare, connect

from tradewind.llm.oracles import llm_oracles
from tradewind.llm.queries import llm_queries


@pytest.mark.parametrize("name", sorted(llm_queries()))
def test_rows(spark, small, name):
    good, note = compare(spark, connect(small), small, llm_queries()[name], llm_oracles().get(name))
    assert good, note
