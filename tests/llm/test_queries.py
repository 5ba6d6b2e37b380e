"""Queries of the subpackage against their SQL."""

import public_tokenizers
import pytest
from compare import duck, duck_rows, spark_rows
from tokenizers import Tokenizer

from skyledger.llm.queries import ORACLES, QUERIES, op10_token_counts

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", list(ORACLES))
def test_matches_sql(spark, name):
    got, want = spark_rows(QUERIES[name](spark, SF)), duck_rows(duck(SF), ORACLES[name])
    assert got[0] == want[0] and len(got[1]) == len(want[1]) > 0
    assert got[1] == want[1]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_token_counts_of_any_file_are_the_librarys(spark, name):
    library = Tokenizer.from_file(public_tokenizers.path(name))
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = {r.doc_id: len(library.encode(r.text or "", add_special_tokens=False).ids) for r in rows}
    assert {r.doc_id: r.n_tokens for r in op10_token_counts(spark, SF, name).collect()} == want
