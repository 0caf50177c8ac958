"""Every registered query of the catalogue against its oracle, on the smallest data set."""

import os

import pytest

import __spark_entry__ as contract
from check_oracle import compare, connect
from vanewright.catalog.registry import entries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data absent")
ENTRIES = entries()

#: Where SQL cannot say the result, it can say what the result must agree with: (expression over the result, SQL).
FACTS = {
    "t1_html_to_markdown": ("count(distinct page_id), sum(cast(chars > 0 as int))", "SELECT count(*), count(*) FROM pages"),
    "t2_guide_fragments": ("count(distinct page_id), sum(cast(section = 'Example' as int)), count(*)",
                           "SELECT count(*), count(*), sum(2 + len(regexp_extract_all(html, '<h[1-6]>'))) FROM pages"),
    "w9_lowess": ("count(distinct event_id), count(predicted_rul_smooth)", "SELECT count(*), count(*) FROM events"),
}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("key", list(ENTRIES))
def test_query(spark, con, key):
    df = ENTRIES[key].run(spark, SF)
    if ENTRIES[key].sql:
        problems, _ = compare(df, con, ENTRIES[key].sql)
        assert not problems
    elif key in FACTS:
        got, want = FACTS[key]
        assert tuple(df.selectExpr(*split(got)).first()) == con.sql(want).fetchall()[0]
    else:  # chosen by a hash: the same rows each time, and some
        rows = sorted(map(str, df.collect()))
        assert rows and rows == sorted(map(str, ENTRIES[key].run(spark, SF).collect()))


def split(expressions):
    """At commas outside brackets."""
    out, depth = [""], 0
    for c in expressions:
        depth += (c == "(") - (c == ")")
        if c == "," and not depth:
            out.append("")
        else:
            out[-1] += c
    return out


def test_flagship(spark):
    assert contract.entry(spark).count() > 0


def test_every_oracle_belongs_to_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries()) and set(ENTRIES) <= set(contract.queries())


def test_only_an_absent_module_is_optional(monkeypatch):
    assert contract._optional("vanewright.llm_that_is_not_there") is None

    def broken(name):
        raise ModuleNotFoundError("No module named 'some_tokenizer'", name="some_tokenizer")
    monkeypatch.setattr(contract.importlib, "import_module", broken)
    with pytest.raises(ModuleNotFoundError):
        contract._optional("corpus_pipeline")
