"""The audit against a brute-force run of every order of filters over every document."""

import itertools
from collections import Counter, defaultdict

from terrasync.llm import filter_audit

LABELS = "doc_id bigint, quality int, toxic int, part string, n bigint"


def brute(rows, labels):
    """rows: (id, text, part). Applies the filters of each order, one document after the other."""
    first = {}
    for i, text, _ in rows:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    failed = []
    for i, text, _ in rows:
        t = text or ""
        w = t.encode().split()
        failed.append(
            {
                name
                for name, fails in {
                    "A": len(w) < 100,
                    "B": 100 * len(set(w)) < 80 * len(w),
                    "C": 100 * sum(c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" for c in t) > 10 * len(t),
                    "D": any(c in t for c in "#$%&*|"),
                    "E": i is not None and first[t] < i,
                }.items()
                if fails
            }
        )
    out, removed = {}, defaultdict(Counter)
    for part in {p or "" for *_, p in rows}:
        mine = [(i, f) for (i, _, p), f in zip(rows, failed, strict=True) if (p or "") == part]
        for order in itertools.permutations("ABCDE"):
            for step, name in enumerate(order, 1):
                c = Counter(kept=0, removed=0, redundant=0, unique_fails=0, good_lost=0, toxic_lost=0)
                for i, f in mine:
                    gone = bool(f & set(order[: step - 1]))
                    c["unique_fails"] += f == {name}
                    c["redundant"] += name in f and gone
                    c["kept"] += not gone and name not in f
                    if name in f and not gone:
                        c["removed"] += 1
                        c["good_lost"] += i in good
                        c["toxic_lost"] += i in toxic
                out[part, "".join(order), step] = c
                removed[part][name] += c["removed"]
    return {k: (*c.values(), removed[k[0]][k[1][k[2] - 1]]) for k, c in out.items()}


def got(found):
    return {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in found.collect()}


def test_against_brute_force(spark, odd, odd_rows):
    labels = [(i, i % 2, i % 3 == 0, "x", 1) for i in range(30)] + [(6, 0, 0, "x", 1), (6, 1, 1, "x", 1), (None, 1, 1, "x", 1), (7, None, None, "x", 1), (999, 1, 1, "x", 1)]
    known = [(i, q, t) for i, q, t, *_ in labels if i is not None]
    found = filter_audit.audit(odd, spark.createDataFrame([(i, q, None if t is None else int(t), p, n) for i, q, t, p, n in labels], LABELS))
    want = brute([(r[0], r[1], r[2]) for r in odd_rows], known)
    assert got(found) == want and len(want) == 600 * len({r[2] for r in odd_rows})
    assert [f.dataType.simpleString() for f in found.schema] == ["string", "string", "int", *["bigint"] * 7]


def test_empty(spark, odd, none):
    nothing = spark.createDataFrame([], LABELS)
    assert filter_audit.audit(none, nothing).isEmpty()
    assert {(r.good_lost, r.toxic_lost) for r in filter_audit.audit(odd, nothing).collect()} == {(0, 0)}


def test_edges_are_eighty_and_shapley_sums_to_removals(spark):
    sets = spark.createDataFrame([("p", 0b10011, 7, 2, 1), ("p", 0b00100, 5, 0, 0), ("p", 0, 3, 1, 0)], "part string, mask int, n long, n_good long, n_toxic long")
    found = filter_audit.edges(sets).collect()
    assert len(found) == 80
    shapley = {r.next: r.shapley for r in found}
    assert shapley == {0: 280, 1: 280, 2: 600, 3: 0, 4: 280}  # a document that fails three filters goes by each in a third of 120 orders


def test_long_text_is_split_between_words(monkeypatch):
    text = ("aé b\tccc\n" * 40).encode()
    whole = filter_audit.Counts(text, 1)
    monkeypatch.setattr(filter_audit, "PIECE", 7)
    cut = filter_audit.Counts(text, 1)
    assert (cut.n_words, cut.distinct) == (whole.n_words, whole.distinct) == (120, {b"a\xc3\xa9", b"b", b"ccc"})
