"""Base phrases and template labels against brute force."""

import random
import re

from trailmark.llm import licenses


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(text):
    words, places, base = plain_words(text), [], set()
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        hits = [i for i in range(len(words)) if words[i:i + len(p)] == p]
        places += hits
        base |= {label} if hits else set()
    labels, score = set(base), 1.0 if places else 0.0
    for line in re.sub("[A-Z]", lambda m: m[0].lower(), text or "").split("\n"):
        line = plain_words(line)
        for at in range(0, max(1, len(line) - licenses.WINDOW // 2), licenses.WINDOW // 2):
            block = {*line[at:at + licenses.WINDOW]}
            for template, label in licenses.TEMPLATES.items():
                want = {*template.split()}
                share = len(want & block) / len(want)
                if share >= licenses.CONTAINMENT:
                    labels.add(label)
                    score = max(score, share)
    return (len(words), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(base)), ",".join(sorted(labels)), score)


def _check(docs_of, texts):
    got = licenses.scan(docs_of(list(enumerate(texts)))).collect()
    assert len(got) == len(texts)
    for r in got:
        assert tuple(r)[1:] == plain(texts[r.doc_id]), texts[r.doc_id]


def test_known_texts(docs_of):
    _check(docs_of, [
        None, "", "...", "Licensed under the Apache License, Version 2.0.", "Released under the MIT License.",
        "CC BY-NC cc by nc, cc by-nc-cc by nc", "under the MIT\nlicense", "sunder the mit license",
        "This work is licensed under the GNU General Public License, version 2.",
        "the general public license of the work", "UNDER THE mİT LICENSE under the MIT license K",
        "é under the mit license\x7funder the mit license", "word " * 70000 + "apache license version 2",
        " ".join(f"w{i}" for i in range(90)) + " released under the mit license " + "x " * 200,
        "0 4 nc by cc under licensed"])


def test_random_texts(docs_of):
    rng = random.Random(5)
    words = sorted({w for t in licenses.TEMPLATES for w in t.split()})
    texts = []
    for _ in range(150):
        lines = []
        for _ in range(rng.randint(0, 5)):
            base = rng.choice(list(licenses.TEMPLATES)).split() if rng.random() < 0.6 else []
            line = [w for w in base if rng.random() > 0.07] + rng.choices(words, k=rng.randint(0, 6))
            if rng.random() < 0.3:
                rng.shuffle(line)
            lines.append(rng.choice([" ", ", ", "-"]).join(line))
        texts.append("\n".join(lines))
    _check(docs_of, texts)


def test_repeats_and_empty_table(docs_of):
    got = licenses.scan(docs_of([(1, "cc by nc"), (1, "cc by nc"), (None, "cc by nc")])).collect()
    assert len(got) == 3 and all(r.n_base == 1 for r in got)
    assert licenses.scan(docs_of([])).count() == 0


def test_no_python_in_the_plan(docs_of):
    plan = licenses.scan(docs_of([(1, "a")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "MapIn" not in plan


def test_wrapped_notices(docs_of):
    mit = ("Permission is hereby granted, free of charge, to any person obtaining a copy\n"
           "of this software and associated documentation files (the \"Software\"), to deal\n")
    bsd = ("Redistribution and use in source and binary forms, with or without\n"
           "modification, are permitted provided that the following conditions are met:\n")
    texts = ["Copyright\n\n" + mit, bsd, "word " * 100 + "\n" + bsd + "word\n" * 100, "released under\n" + "x " * 70 + "mit"]
    got = {r.doc_id: r.labels for r in licenses.scan(docs_of(list(enumerate(texts))), across_lines=True).collect()}
    assert got == {0: "mit", 1: "bsd", 2: "bsd", 3: ""}
    assert {r.labels for r in licenses.scan(docs_of([(0, texts[3])])).collect()} == {""}
