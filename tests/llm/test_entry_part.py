"""The training-data part as the entry point sees it."""

import public_tokenizers

from shelfline.llm.queries import PATTERN
from tests.test_entry import REPO, names


def test_queries_without_the_tokenizer_package():
    assert PATTERN == public_tokenizers.PATTERN
    found = names(REPO, ["public_tokenizers"]).stdout.split()
    assert {"op2_bpe", "op6_token_files", "pipeline", "sales_kpis"} <= set(found)


def test_failing_imports_are_told():
    found = names(REPO, ["numpy"])
    assert found.returncode and "numpy" in found.stderr
