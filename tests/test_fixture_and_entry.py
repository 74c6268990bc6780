"""The posting fixture at sf0.001 (FIXTURES 1 figures) and the driver contract."""

import __spark_entry__ as entry
import oracle_sql
from postlens import schema
from postlens.functions.parse import gate
from postlens.operators import dimensions, salary, skills
from postlens.plans import registry
from postlens.plans.registry import fixture_postings
from postlens.sources.text import keyword_dictionary
from tests.conftest import SF_SMALL


def test_fixture_figures(spark):
    p = fixture_postings(spark, SF_SMALL).cache()
    assert p.count() == 1500
    assert gate(p, min_fields=5).count() == 1400
    assert gate(p, min_fields=10).count() == 1297
    assert gate(p, exact=11).count() == 1184
    hist = {r["n_fields"]: r["count"] for r in p.groupBy("n_fields").count().collect()}
    assert hist == {3: 89, 4: 11, 5: 98, 8: 1, 9: 4, 10: 113, 11: 1184}
    full = gate(p, exact=11)
    ceil = salary.histogram(full, 1, (0, 40000, 5000)).collect()
    assert (len(ceil), sum(r["n"] for r in ceil)) == (8, 388)
    floor = salary.histogram(full, 0, (0, 40000, 5000)).collect()
    assert (len(floor), sum(r["n"] for r in floor)) == (8, 572)
    coh = salary.histogram(salary.cohort(full), 1, (0, 40000, 5000)).collect()
    assert sum(r["n"] for r in coh) == 35
    ge5 = gate(p, min_fields=5)
    assert sum(r["n"] for r in salary.histogram(ge5, 0, (0, 40000, 3000)).collect()) == 682
    assert sum(r["n"] for r in salary.histogram(ge5, 1, (0, 40000, 3000)).collect()) == 457
    dims = {}
    for r in dimensions.counts(gate(p, min_fields=10)).collect():
        v, n = dims.get(r["dim"], (0, 0))
        dims[r["dim"]] = (v + 1, n + r["n"])
    assert dims == {"address": (25, 1111), "companyType": (5, 1297), "companyPnum": (5, 1297),
                    "experience": (3, 973), "education": (3, 1245)}
    kw = {r["token"]: r["n"] for r in skills.keyword_counts(full, keyword_dictionary(spark)).collect()}
    assert kw == {"hadoop": 236, "java": 237, "linux": 1184, "mysql": 237, "spark": 237, "数据挖掘": 592, "算法": 592}
    p.unpersist()


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["section", "key", "n"]
    assert {r["section"] for r in rows} >= {"salary_0", "salary_1", "address", "skill_bg"}


def test_every_query_has_an_oracle_or_is_known():
    qs, oracles = registry.registered(), oracle_sql.queries()
    assert set(oracles) == set(qs)
    assert set(qs) <= set(entry.queries()) and set(oracles) <= set(entry.oracle_sql()) <= set(entry.queries())
    assert schema.GATE_FULL == 11


def test_result_store_latest_cells_figure(spark):
    from postlens.plans.registry import q_cell_store_latest

    assert q_cell_store_latest(spark, SF_SMALL).count() == 75
