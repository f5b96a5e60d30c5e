import __spark_entry__ as E
from lexrev.llm.queries import ORACLE_SQL, QUERIES


def test_registry_names():
    assert [k.split("_")[0] for k in QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert set(QUERIES) | {"pipeline"} <= set(E.queries())
    assert set(ORACLE_SQL) <= set(E.oracle_sql())
