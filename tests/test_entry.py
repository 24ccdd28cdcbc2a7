import importlib
import sys


def test_entry_without_the_training_data_queries(monkeypatch, capsys):
    """A missing subpackage, or a package that only it needs, leaves the other queries."""
    import __spark_entry__ as entry
    for name in ("contrail.llm", "xxhash", "sentencepiece"):
        with monkeypatch.context() as m:
            for loaded in [x for x in sys.modules if x == "corpus_pipeline" or x.startswith("contrail.llm")]:
                m.delitem(sys.modules, loaded)
            m.setitem(sys.modules, name, None)
            bare = importlib.reload(entry)
            queries, oracles = set(bare.queries()), set(bare.oracle_sql())
            if name != "sentencepiece":
                assert "pipeline" not in queries and not any(q.startswith("op1") for q in queries)
                assert "not registered" in capsys.readouterr().err
            assert "airline_performance" in queries and oracles <= queries and len(queries) > 100
    importlib.reload(entry)
