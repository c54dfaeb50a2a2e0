from feedertrace import session


def test_grown_heap_is_collected(spark, monkeypatch):
    for make in (lambda df: session.materialize(df, "t"), session.checkpoint):
        for share, collected in ((0.0, True), (2.0, False)):
            monkeypatch.setattr(session, "_HEAP_SHARE", share)
            monkeypatch.setattr(session, "_heap", 0)
            assert make(spark.range(3)).count() == 3 and (session._heap > 0) == collected
