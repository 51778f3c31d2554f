"""Every query with an SQL twin gives the same rows in both engines."""

import pytest

from conftest import SF_DIR
from inkfold.plans import check, oracles, queries


@pytest.fixture(scope="module")
def duck():
    return check.connect(SF_DIR)


def test_every_twin_has_a_query():
    assert set(oracles.sql()) <= set(queries.REGISTRY)


@pytest.mark.parametrize("name", sorted(oracles.sql()))
def test_same_rows(spark, duck, name):
    assert check.compare(spark, duck, SF_DIR, name) == ""


def test_values_that_both_engines_import():
    """Twins read these from the code they check, so they are written out here."""
    from inkfold.functions import fixed_values as v

    assert list(v.FIELDS) == ["Location", "Description", "Date", "Photographer", "Film"]
    assert {k: v.LABEL_TO_FIELD.get(k, "Description") for k in ("LOC", "GPE", "PER", "PERSON", "DATE", "FILM", "MISC")} == {
        "LOC": "Location", "GPE": "Location", "PER": "Photographer", "PERSON": "Photographer", "DATE": "Date", "FILM": "Film", "MISC": "Description"}
    assert {"Januar", "Feber", "Mai", "Oktober", "Nov."} <= set(v.MONTHS) and not {"ZV", "mai", "1948"} & set(v.MONTHS)
    assert list(v.METRIC_LABELS) == ["accuracy", "fm", "mcc", "psnr", "nrm", "drdm"]


def test_entry_points(spark):
    import __spark_entry__ as entry

    rows = entry.entry(spark).collect()
    assert {r["source"] for r in rows} == {"drop words", "mask letters", "insert marks"}
    assert set(entry.oracle_sql()) <= set(entry.queries())
