import random
import re

from terrasync.llm import quality as Q


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    twice = {i for i, w in enumerate(windows) if windows.count(w) > 1}
    repeat = len({j for i in twice for j in range(i, i + 5)})
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), repeat


def test_measures():
    rng = random.Random(4)
    texts = [None, "", " \n ", "a a a a a a", "a b c d e a b c d e", "x y\x1cz", "l\n l\nl\n\n", "#*$%&|<>", "a\nb\na\n"]
    texts += ["".join(rng.choice(["a ", "b ", "c", "\n", "é ", "# "]) for _ in range(rng.randint(0, 120))) for _ in range(60)]
    for t in texts:
        d = Q.Document(t)
        assert (d.n_words, d.word_chars, d.n_symbols, d.n_dup_lines, d.n_repeat_words) == brute(t)


def test_many_different_words():
    words = [str(i) for i in range(7000)]
    assert Q.Document(" ".join(words + words[:5])).n_repeat_words == 10


def test_spark(odd, odd_rows, none):
    got = Q.judge(odd, measures=True).collect()
    short = [r for r in odd_rows if len(r[1] or "") < 10_000]
    want = sorted((str(r[0]), *brute(r[1])) for r in short)
    mine = sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got if r.doc_id != 5)
    assert mine == want and len(got) == len(odd_rows)
    for r in got:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)
    kept = Q.keep_good(odd)
    assert kept.schema == odd.schema and kept.count() == sum(r.kept for r in got)
    assert Q.judge(none).collect() == [] and Q.keep_good(none).collect() == []


def test_order_does_not_change_verdicts(odd, odd_rows):
    for rules in (Q.RULES, Q.RULES[::-1]):
        ordered = Q.plan_cascade(odd, rules)
        assert set(ordered) == set(rules)
        assert [Q.passes(Q.Document(r[1]), ordered) for r in odd_rows] == [Q.passes(Q.Document(r[1]), Q.RULES) for r in odd_rows]


def test_cascade_stops_at_the_first_rejection():
    seen = []
    rules = (Q.Rule("no", lambda d: True), Q.Rule("late", lambda d: seen.append(d)))
    assert not Q.passes(Q.Document("x"), rules) and not seen


def test_useful_cheap_rule_goes_first(spark):
    df = spark.createDataFrame([("w " * 3000 + str(i),) for i in range(40)] + [("short",)] * 40, "text string")
    assert Q.plan_cascade(df, Q.BASE_RULES + (Q.Rule("never", lambda d: False),))[-1].name == "never"
