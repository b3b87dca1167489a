"""Models are fitted at the same time, on training rows that are shuffled once."""

from threading import Barrier

from fixtures import daily_cycle, series
from hearthwatt.operators import featured_series, modelling


def test_fits_wait_for_each_other_and_share_rows(spark, monkeypatch):
    together, seen = Barrier(3, timeout=30), []

    class Waiting:
        def __init__(self, **options):
            pass

        def fit(self, rows):
            seen.append((rows, rows.storageLevel.useDisk))
            together.wait()
            return self

    monkeypatch.setattr(modelling, "_REGRESSORS", dict.fromkeys(("linear", "forest", "gbt"), Waiting))
    fitted = modelling.fit_forecast(featured_series(series(spark, daily_cycle()), include_current=False))
    assert list(fitted.regressors) == ["linear", "forest", "gbt"]
    assert [on_disk for _, on_disk in seen] == [True] * 3
    assert not any(rows.storageLevel.useDisk for rows, _ in seen)
