"""Driver contract: the entry file loads by path and the flagship schema is stable."""

import importlib.util
import os

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _load():
    spec = importlib.util.spec_from_file_location("entry_by_path", os.path.join(HERE, "__spark_entry__.py"))
    m = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(m)
    return m


def test_entry_loads_by_path_and_schema_is_stable(spark):
    m = _load()
    a, b = m.entry(spark), m.entry(spark)
    assert a.schema == b.schema and a.count() > 0
    qs, sql = m.queries(), m.oracle_sql()
    assert set(sql) <= set(qs) and all(callable(f) for f in qs.values())
    assert all(isinstance(v, str) and v.strip() for v in sql.values())
