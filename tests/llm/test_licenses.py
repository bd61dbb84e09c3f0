import random

from helpers import documents, random_texts

import brute
from rainroute.llm import licenses

MIT = dict((t[:20], t) for label, t in licenses.TEMPLATES if label == "mit")["Permission is hereby"]
ROWS = [
    (1, "See the MIT-License, mit license mit license"),
    (2, "apache\nLicense; the GNU general PUBLIC license"),
    (3, None),
    (4, ""),
    (5, "mit"),
    (6, "xmit license mit licenses"),
    (7, "some words before " + MIT + " and after"),
    (8, MIT.replace("deal in the Software", "deal in all of the said Software") + " tail"),
    (8, MIT),
    (8, MIT),
    (9, " ".join(reversed(MIT.split()))),
    (None, "général public license général"),
    (11, "Licensed under CC BY-NC 4.0.\n" + "word " * 30_000 + "general public license"),
    (12, "MİT license Apache LICENSE"),
]


def test_base_against_brute_force_and_spans(spark):
    rows = ROWS + list(enumerate(random_texts(6, 20), 100))
    df = documents(spark, rows, "found int, label string, k1 string", (1, "l", "k"))
    got = licenses.scan(df).collect()
    want = []
    for i, t in rows:
        n, places, labels = brute.base_places(t, licenses.BASE)
        want.append((i, n, len(places), min(places, default=None), max(places, default=None), ",".join(labels)))
    key = lambda r: tuple(str(x) for x in r)
    assert sorted([(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got], key=key) == sorted(want, key=key)
    labels = {r.doc_id: r.labels for r in got}
    assert labels[7] == "mit" and labels[8] == "mit" and labels[9] == "" and labels[11] == "cc-by-nc,gpl"
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in got)
    (span,) = next(r.spans for r in got if r.doc_id == 7)
    words = MIT.replace(",", " ").replace("(", " ").replace(")", " ").replace("/", " ").replace(":", " ").split()
    assert (span.first, span.last, span.cover) == (3, 2 + len(words), 1.0)
    edited = [r for r in got if r.doc_id == 8]
    assert sorted(round(r.score, 2) for r in edited)[1:] == [1.0, 1.0] and edited[0].score > 0.8
    assert all(0 <= r.score <= 1 for r in got)


def test_spans_labels_and_score_against_brute_force(spark):
    rng = random.Random(5)
    templates = licenses.TEMPLATES + licenses.WHOLE
    texts = [None, "", "mit license", "WITHOUT wor\u212a MIT L\u0130CENSE", MIT.replace("copy", "\u212aopy")]
    for label, body in templates:
        given = body.split()
        for put_in, left_out in ((0, 0), (1, 1), (4, 0), (0, 5), (12, 12)):  # up to DRIFT in one place, and beyond it
            edited = list(given)
            at = rng.randrange(len(edited))
            edited[at : at + left_out] = [f"x{i}" for i in range(put_in)]
            texts.append(" ".join(["before", *edited, *given[: len(given) // 3], "after"]))
        texts.append(" ".join([*given, *given]))
    rows = list(enumerate(texts))
    got = {r.doc_id: r for r in licenses.scan(documents(spark, rows, "label string, spans int, cover double, first int", ("l", 1, 0.5, 2))).collect()}
    for i, t in rows:
        want = brute.license_spans(t, templates, licenses.K, licenses.DRIFT, licenses.COVER)
        assert sorted(tuple(s) for s in got[i].spans) == want
        _, places, base = brute.base_places(t, licenses.BASE)
        assert got[i].labels == ",".join(sorted({*base, *(s[2] for s in want)}))
        assert got[i].score == (1.0 if places else max((s[3] for s in want), default=0.0))


def test_whole_licenses_are_named(spark):
    rows = [(i, f"Title\n\nCopyright (c) 2020 A. Author\n\n{body}") for i, (_, body) in enumerate(licenses.WHOLE)]
    for r in licenses.scan(documents(spark, rows)).collect():
        assert licenses.WHOLE[r.doc_id][0] in r.labels.split(",") and r.score == 1.0


def test_empty_table(spark):
    assert licenses.scan(documents(spark, [])).collect() == []


def test_no_python_in_the_plan(spark, tiny):
    from conftest import plan

    text = plan(licenses.op5_license_scans(spark, tiny))
    assert not any(x in text for x in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))
