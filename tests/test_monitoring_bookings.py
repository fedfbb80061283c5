"""The exact drift query derives the bookings once."""

from tidewheel.plans import inputs, monitoring_queries


def test_exact_drift_derives_bookings_once(spark, sf_dir, monkeypatch):
    made, build = [], inputs.bookings
    monkeypatch.setattr(inputs, "bookings", lambda *args: made.append(args) or build(*args))
    assert monitoring_queries.monitoring_drift_exact(spark, sf_dir).count() == 60
    assert len(made) == 1
