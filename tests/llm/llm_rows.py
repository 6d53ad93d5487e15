"""Rows that every operator must survive, and the fixture that adds clashing columns to them."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF_SMALL = "/root/testdata/sf0.001"

NASTY = [(1, None), (2, ""), (3, "   "), (4, "one two three four five six"), (5, "word " * 30_000), (None, "no id at all here"),
         (4, "one two three four five six"), (7, "ONE two three four five SIX"), (8, "ü é 漢字 \x00 end")]


@pytest.fixture(scope="session")
def docs_of(spark):
    """Tables of (doc_id, text) rows with further columns whose names operators use themselves."""

    def make(rows, schema="doc_id long, text string"):
        df = spark.createDataFrame(rows, schema)
        return df.selectExpr("*", "'x' as score", "'y' as row", "'z' as leaks", "'w' as n_lines")

    return make
