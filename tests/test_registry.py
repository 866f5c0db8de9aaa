"""Registry hygiene: every query builds lazily, output names are lower-case
identifiers without spaces and unique (two-engine rule of SURVEY 7.4)."""

import re

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

NAME = re.compile(r"^[a-z_][a-z0-9_]*$")


@pytest.mark.parametrize("key", sorted(E.queries()))
def test_output_names(spark, key):
    cols = E.queries()[key](spark, SF_SMALL).columns
    assert len(cols) == len(set(cols)), cols
    assert all(NAME.match(c) for c in cols), cols
