import __spark_entry__ as entry


def test_sql_belongs_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    assert entry.entry(spark).count() == 64


def test_without_the_corpus_part(monkeypatch):
    monkeypatch.setattr(entry, "find_spec", lambda name: None)
    names = entry.queries()
    assert "max_merge" in names and "pipeline" not in names and not any(n.startswith("op") and n[2].isdigit() for n in names)
    assert set(entry.oracle_sql()) <= set(names)
