"""The working folder for intermediate tables."""

from palimpsest import session


def test_working_folder_is_the_configured_one(spark, monkeypatch):
    monkeypatch.setattr(session, "CHECKPOINT_DIR", "spark.sql.warehouse.dir")
    assert session.working_folder(spark) == spark.conf.get("spark.sql.warehouse.dir").rstrip("/")


def test_local_sessions_fall_back_to_one_folder(spark, monkeypatch):
    monkeypatch.setattr(session, "CHECKPOINT_DIR", "spark.test.unset")
    folder = session.working_folder(spark)
    assert folder and session.working_folder(spark) == folder
    assert session.staged(spark.range(5), "five").count() == 5
