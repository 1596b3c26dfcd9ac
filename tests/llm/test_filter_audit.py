"""The filter audit against a plain walk over all documents and orders."""

import itertools
import random
import re

import pytest

from hearthscore.llm import filter_audit

SCHEMA = "doc_id long, text string, source string, mask int, part string, id long, good string"


def failed(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {
        "A": len(words) < 200,
        "B": 100 * len(set(words)) < 50 * len(words),
        "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
        "D": any(c in text for c in "#$%&*|"),
    }


def brute_force(docs, labels):
    texts = [(d, t or "", s or "") for d, t, s in docs]
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, x in labels if x == 1 and d is not None}
    fails = []
    for d, t, _ in texts:
        own = failed(t)
        own["E"] = d is not None and any(o is not None and o < d and u == t for o, u, _ in texts)
        fails.append(own)
    out = {}
    for part in {s for _, _, s in texts}:
        rows = [(d, f) for (d, _, s), f in zip(texts, fails) if s == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = rows
            for step, f in enumerate(order, 1):
                gone = [(d, x) for d, x in left if x[f]]
                left = [(d, x) for d, x in left if not x[f]]
                total[f] += len(gone)
                out[part, "".join(order), step] = (
                    len(left),
                    len(gone),
                    sum(x[f] for _, x in rows) - len(gone),
                    sum(x[f] and sum(x.values()) == 1 for _, x in rows),
                    sum(d in good for d, _ in gone),
                    sum(d in toxic for d, _ in gone),
                )
        for order in itertools.permutations("ABCDE"):
            for step, f in enumerate(order, 1):
                out[part, "".join(order), step] += (total[f],)
    return out


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(5)
    rows = [(1, None, "h"), (2, "", None), (3, "", ""), (None, "", "h"), (4, "x " * 90_000, "h"), (4, "x " * 90_000, "h")]
    for i in range(10, 90):
        n, kinds = rng.choice((20, 199, 200, 400)), rng.choice((3, 500))
        words = [f"w{rng.randrange(kinds)}" for _ in range(n)]
        words += rng.choice(([], ["ABCDEFGHI"] * 10, ["a#b"], ["naïve ÀÉ"]))
        rows.append((i, rng.choice((" ", "\n", "\x0b", "  ")).join(words), rng.choice("hh g".split(" "))))
    rows += [(i + 100, rows[i][1], "g") for i in range(10, 30)]
    return rows + [rows[40]] * 3


def test_audit_against_brute_force(spark, docs):
    rng = random.Random(6)
    labels = [(d, rng.randrange(2), rng.randrange(2)) for d, _, _ in docs if d] + [(999, 1, 1), (10, None, 1), (None, 1, 1)]
    df = spark.createDataFrame([(*r, 7, "p", 8, "q") for r in docs], SCHEMA)
    marks = spark.createDataFrame([(*x, "t") for x in labels], "doc_id long, quality int, toxic int, text string")
    got = {(r.part, r.filter_order, r.step): r for r in filter_audit.audit(df, marks).collect()}
    want = brute_force(docs, labels)
    assert set(got) == set(want) and len(got) == 600 * len({p for p, _, _ in got})
    for key, values in want.items():
        r = got[key]
        assert (*[r[c] for c in filter_audit.METRICS], r.shapley) == values
    assert any(v[2] for v in want.values()) and any(v[4] for v in want.values())


def test_no_documents_and_no_labels(spark, odd):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(odd.limit(0), labels).count() == 0
    rows = filter_audit.audit(odd, labels).collect()
    assert {r.part for r in rows} == {"", "h"} and not any(r.good_lost or r.toxic_lost for r in rows)


def test_more_parts_than_the_row_limit_of_recursion(spark):
    docs = spark.range(4000).selectExpr("id as doc_id", "'a b' as text", "cast(id as string) as source")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(docs, labels).count() == 600 * 4000
