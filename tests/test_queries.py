import os

import pytest
from against_sql import DATA, same

from duplexa.plans import workload

pytestmark = pytest.mark.skipif(not os.path.isdir(f"{DATA}/sf0.001"), reason="no tables here")


@pytest.mark.parametrize("name", sorted(workload.ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    same(spark, workload.QUERIES[name], workload.ORACLE_SQL[name], f"{DATA}/sf0.001")


@pytest.mark.parametrize("name", sorted(set(workload.QUERIES) - set(workload.ORACLE_SQL)))
def test_query_without_sql_has_rows(spark, name):
    assert workload.QUERIES[name](spark, f"{DATA}/sf0.001").count() > 0


def test_entry_names_its_columns(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns == ["sirna_id", "chrom", "start", "end", "strand", "transcript_id", "p"]
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_prediction_files_grow_in_number_and_not_in_size(spark, monkeypatch):
    monkeypatch.setattr(workload, "FILE_ROWS", 500, raising=False)
    names = workload.predictions.list_prediction_files(spark, workload._prediction_files(spark, f"{DATA}/sf0.001"))
    rows = [spark.read.text(n).count() for n in names]
    assert sum(rows) > 5000 and max(rows) < 600
    same(spark, workload.QUERIES["summed_arrivals"], workload.ORACLE_SQL["summed_arrivals"], f"{DATA}/sf0.001")
