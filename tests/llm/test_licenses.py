import random

import duckdb
import pandas as pd

from feedertrace.llm import licenses

COLUMNS = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]


def rows(frame):
    plain = lambda c, x: None if pd.isna(x) else str(x) if isinstance(x, str) else round(float(x), 9)
    return sorted(str([plain(c, x) for c, x in zip(COLUMNS, r, strict=True)]) for r in frame[COLUMNS].astype(object).itertuples(index=False))


def test_equals_every_pair_compared(spark):
    rng = random.Random(7)
    parts = ["MIT License", "mit\nlicense", "the Apache-License!", "GNU General Public License.", "license", "MIT", "MİT LICENSE", "licenſe", "naïve Ünder", "foo bar", "\n", ". ", "0 4", "mit license license", "a\x00b", "Work under THE"]
    docs = []
    for i in range(150):
        own = rng.choices(parts, k=rng.randrange(0, 8))
        if rng.random() < 0.6:
            words = rng.choice(licenses.TEMPLATES)[1].split()
            words = [w for w in words if rng.random() > 0.12]
            rng.shuffle(words)
            own.insert(rng.randrange(len(own) + 1), rng.choice([". ", "\n", " "]) + " ".join(words).title() + rng.choice([".", "\n", ""]))
        docs.append((i if i % 9 else None, rng.choice([" ", " ", "\n"]).join(own), i))
    docs += [(500, None, 1), (501, "", 2), (3, "x", 1), (3, "x", 1)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, label int")
    con = duckdb.connect()
    con.register("documents", frame.toPandas())
    want = con.sql(licenses.sql()).df()
    got = licenses.find_licenses(frame)
    assert rows(got.toPandas()) == rows(want) and (want["labels"] != want["base_labels"]).any()
    assert licenses.find_licenses(frame.limit(0)).count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_matches_name_the_block(spark):
    text = "First line\nAll of it is licensed under CC BY-NC 4.0. And more."
    r = licenses.find_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert sorted((m.word, m.label, round(m.share, 3)) for m in r.matches) == [(6, "cc", 0.857), (6, "cc", 1.0)]
    assert r.n_base == 0 and r.first_word is None and r.score == 1.0 and r.labels == "cc"


def test_wrapped_notices(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal\nin the Software without restriction"
    gpl = "# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU General Public License as published by"
    bsd = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions\nare met:"
    mpl = "This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy"
    far = "permission is hereby granted " + "filler words stand here " * 20 + "free of charge to any person obtaining a copy of this software"
    texts = [mit, gpl, bsd, mpl, far, "", None]
    found = licenses.find_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    got = {r.doc_id: r for r in found.collect()}
    assert [got[i].labels for i in range(7)] == ["mit", "gpl", "bsd", "mpl", "", "", ""]
    assert got[2].score == got[3].score == 1.0 and got[4].score == 0.0


def test_recall_of_edited_and_wrapped_notices(spark):
    """Every template, hard-wrapped, amid other words, with a tenth of its words lost: all are found."""
    rng = random.Random(3)
    texts, want = [], []
    for label, template in licenses.TEMPLATES:
        for _ in range(6):
            words = template.split()
            lost = set(rng.sample(range(len(words)), len(words) // 10))
            words = [w.title() if rng.random() < 0.3 else w for i, w in enumerate(words) if i not in lost]
            if len({w.lower() for w in words} & set(template.split())) < 0.8 * len(set(template.split())):
                continue
            lines = [" ".join(words[i : i + 7]) for i in range(0, len(words), 7)]
            texts.append("some prose here\n * " + "\n * ".join(lines) + ".\n" + "and filler words " * 30)
            want.append(label)
    got = {r.doc_id: r.labels.split(",") for r in licenses.find_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert len(texts) > 100 and all(w in got[i] for i, w in enumerate(want))


def test_long_texts(spark):
    text = "the software and of this license copy " * 30_000 + "released under the MIT license"
    r = licenses.find_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert r.n_words == 210_005 and r.labels == "mit" and r.first_word == 210_003
