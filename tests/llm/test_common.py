import random

from bankscope.llm import common

from . import fixtures as B


def test_connected_components(spark):
    rng = random.Random(6)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 160)] + [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(90)]
    got = {r.id: r.component for r in common.connected_components(spark.createDataFrame(edges, "x long, y long"), "x", "y").collect()}
    want = B.components(400, edges)
    assert got == {i: want[i] for e in edges if e[0] != e[1] for i in e}


def test_no_shared_folder_is_an_error(monkeypatch):
    import pytest

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://somewhere"

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError):
        common.shared_dir(Session())
