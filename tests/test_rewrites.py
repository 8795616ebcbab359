"""What a query writes several times is derived once."""

from checks import catalogue
from helpers import plan

SF = "/root/testdata/sf0.001"


def _plans(monkeypatch, name):
    seen, write = [], getattr(catalogue, name)
    monkeypatch.setattr(catalogue, name, lambda df, *a, **k: (seen.append(plan(df)), write(df, *a, **k))[1])
    return seen


def test_versions_are_cut_from_one_cleaning(spark, monkeypatch):
    seen = _plans(monkeypatch, "publish_view")
    assert catalogue.k4_published_view(spark, SF).count() > 0
    assert len(seen) == 2 and not any("Join" in p for p in seen)


def test_landings_come_from_one_run_of_the_consumer(spark, monkeypatch):
    seen = []

    def refreshed(spark, landings, incremental):
        seen.extend(plan(rows) for rows in landings)
        return landings[-1]

    monkeypatch.setattr(catalogue, "_refreshed", refreshed)
    assert catalogue.p2_refresh_incremental(spark, SF).count() > 0
    assert len(seen) == 2 and not any("Join" in p or "Window" in p for p in seen)
