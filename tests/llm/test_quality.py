"""Quality rules: metrics against plain Python, order of the cascade, verdicts that the order cannot change, native plan."""

import random
import re
from collections import Counter

from conftest import plan_text
from llm_fixtures import SMALL_SF, edge_docs, edge_rows, no_docs, prose  # noqa: F401
from pyspark.sql import functions as F

from ticketlens.llm import quality as q
from ticketlens.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept."""
    text = text or ""
    w = WORD.findall(text)
    n = len(w)
    times = Counter(zip(w, w[1:], w[2:]))
    covered = {i + k for i in range(n - 2) if times[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    chars, symbols = sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>")
    dup, repeat = len(lines) - len(set(lines)), len(covered)
    failed = n < 50 or 100 * repeat > 50 * n
    letters = sum(any(c.isalpha() for c in x) for x in w)
    shouted = sum(len(run) > 1 for run in re.findall(r"[A-ZÄÉ]+", text))
    bad = (
        failed or 10 * symbols > n or dup >= 3 and 100 * dup > 30 * len(lines) or not 3 * n <= chars <= 10 * n
        or 100 * letters < 80 * n or 2 * shouted > n
    )
    return n, chars, symbols, dup, repeat, failed, not bad


def odd_texts():
    rs = random.Random(5)
    texts = [None, "", " \t\r\n", "a", "a a", "a a a", "a a a a", "a b c a b c", "x y \x1f\x1c z \x0b\x0c", "é€😀 " * 60]
    texts += [" ".join(rs.choice("ab") for _ in range(rs.randint(1, 90))) for _ in range(40)]  # overlapping repeats
    texts += ["".join(rs.choice("ab \n\t#|Äé😀\x01") for _ in range(rs.randint(1, 300))) for _ in range(60)]
    texts += [prose(i, 60) + "\n" + prose(i % 3, 20) + "\n" + prose(i % 3, 20) for i in range(20)]
    clean = prose(77, 120)
    texts += [clean, clean.upper(), clean.replace(" ", " ### "), "\n".join([clean[:90]] * 6), " ".join(["longwordwithoutend"] * 5 + clean.split())]
    return texts + [" ".join(f"w{i:05d}" for i in range(60_000)) + " w00007 w00008 w00009"]  # very long


def table(spark, texts):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, kept string, n_words int")


def test_metrics_and_verdicts_against_plain_python(spark):
    texts = odd_texts()
    got = {r[0]: tuple(r)[1:] for r in q.quality_table(table(spark, texts)).collect()}
    assert got == {i: plain(t) for i, t in enumerate(texts)}


def test_every_rule_rejects_and_clean_prose_stays(spark):
    clean = prose(1, 200)
    cases = {
        "few_words": prose(2, 30), "repeated_words": prose(3, 20) + (" one two three" * 20), "symbols": clean.replace(" ", " # "),
        "repeated_lines": "\n".join([prose(4, 30)] * 4 + [prose(5, 80)]), "short_words": " ".join(f"{i % 97} y" for i in range(60)),
        "long_words": " ".join(f"abcdefghijk{i}" for i in range(60)), "no_letters": " ".join(f"{i:05d}" for i in range(99)), "shouting": clean.upper(),
    }
    rows = spark.createDataFrame([*cases.items(), ("none", clean)], "name string, text string")
    on = {r.name: r.on(lambda m: q.METRICS[m](F.col("text"))) for r in q.RULES}
    found = {r["name"]: [k for k in on if r[f"_{k}"]] for r in rows.select("name", *[c.alias(f"_{k}") for k, c in on.items()]).collect()}
    assert found["none"] == []
    assert all(name in found[name] for name in cases), found
    assert [r["name"] for r in q.keep_quality(rows).collect()] == ["none"]


def test_order_by_rejections_per_second():
    rules = q.RULES[:3]
    names = [r.name for r in rules]
    together = {frozenset(names[:1]): 10, frozenset(names[:2]): 30, frozenset(names[2:]): 20, frozenset(): 40}
    # the first rejects 40 per second; what it leaves, the second rejects none of
    order = q.cascade_order(rules, q.Measured({names[0]: 1.0, names[1]: 0.9, names[2]: 2.0}, together))
    assert [r.name for r in order] == [names[0], names[2], names[1]]
    # a dear rule goes last however much it rejects
    order = q.cascade_order(rules, q.Measured({names[0]: 1000.0, names[1]: 1.0, names[2]: 2.0}, together))
    assert [r.name for r in order] == [names[1], names[2], names[0]]
    assert q.cascade_order((), q.Measured({}, {})) == ()


def test_cascade_stops_at_the_first_rejection(spark):
    """A rule behind the one that rejects is not evaluated."""
    rows = spark.createDataFrame([("short",)], "text string")
    bomb = q.Rule("bomb", ("n_words",), lambda n: F.raise_error(F.concat(F.lit("ran on "), F.col("text"))).cast("boolean"))
    on = lambda m: q.METRICS[m](F.col("text"))
    assert rows.where(q.kept((q.RULES[0], bomb), on)).collect() == []


def test_measure_counts_joint_rejections(spark):
    docs = table(spark, [prose(1, 10)] * 3 + [prose(2, 100)] * 2 + [None])
    m = q.measure(docs)
    assert set(m.seconds) == {r.name for r in q.RULES} and all(x > 0 for x in m.seconds.values())
    assert m.together == {frozenset({"few_words"}): 4, frozenset(): 2}


def test_edge_rows_and_empty_table(spark, edge_rows, edge_docs, no_docs):  # noqa: F811
    got = sorted(map(tuple, q.quality_table(edge_docs).collect()), key=repr)
    assert got == sorted(((r[0], *plain(r[1])) for r in edge_rows), key=repr)
    assert q.keep_quality(edge_docs).columns == edge_docs.columns
    assert q.quality_table(no_docs).collect() == [] and q.keep_quality(no_docs).collect() == []


def test_query_runs_no_python_and_shuffles_nothing(spark):
    plan = plan_text(QUERIES["op11_rule_cascade"](spark, SMALL_SF), "formatted")
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)
