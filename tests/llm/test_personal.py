"""Personal data: patterns against plain regular expressions, gradients, windows, edge rows."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import SMALL_SF, edge_docs, edge_rows, no_docs, prose  # noqa: F401

from ticketlens.llm import personal
from ticketlens.llm.personal import Finder, base_spans, joined, luhn, personal_data, reconciled, train, train_tagger
from ticketlens.llm.tagger import Tagger

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")


def plain_spans(text):
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append(("phone", *m.span()))
    return sorted(out, key=lambda s: (s[1], personal.KINDS.index(s[0])))


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab.@- 019+()é%", max_size=40))
def test_base_spans_are_the_patterns_spans(text):
    assert base_spans(text) == plain_spans(text)


def test_base_spans_on_planted_text():
    text = "é x.y9@m.example.com, 10.2.3.255 300.1.1.1; 4845 1681-1440 7329, +1 (017) 555-7713, 4845168114407328"
    assert [text[a:b] for _, a, b in base_spans(text)] == ["x.y9@m.example.com", "10.2.3.255", "4845 1681-1440 7329", "+1 (017) 555-7713"]
    assert luhn("4845168114407329") and not luhn("4845168114407328")


def test_long_runs_stay_linear():
    text = "a" * 200_000 + "@" + "b" * 200_000 + " " + "1" * 200_000
    assert base_spans(text) == []


def test_gradient():
    rs = np.random.RandomState(0)
    t = Tagger.new(7, 3, 4, 0)
    t.params = {k: v.astype(np.float64) for k, v in t.params.items()}
    x, y = rs.randint(0, 7, (3, 6)), rs.randint(0, 3, (3, 6))
    _, grad = t.gradient(x, y)
    for k, v in t.params.items():
        at = tuple(rs.randint(0, s) for s in v.shape)
        old, e = v[at], 1e-4
        v[at] = old + e
        up, _ = t.gradient(x, y)
        v[at] = old - e
        down, _ = t.gradient(x, y)
        v[at] = old
        assert abs((up - down) / (2 * e) - grad[k][at]) < 3e-4, k


def test_best_path_and_marginals_against_all_paths():
    t = Tagger.new(5, 3, 3, 1)
    rs = np.random.RandomState(2)
    t.params["trans"] = rs.normal(size=(3, 3)).astype(np.float32)
    x = rs.randint(0, 5, (1, 5))
    e = t.scores(x)[0]
    paths = list(itertools.product(range(3), repeat=5))
    score = [
        t.params["first"][p[0]] + sum(e[i, p[i]] for i in range(5)) + sum(t.params["trans"][a, b] for a, b in zip(p, p[1:]))
        for p in paths
    ]
    weight = np.exp(np.array(score, dtype=np.float64))
    tags, marginal = t.decode(x)
    best = paths[int(np.argmax(score))]
    assert tuple(tags[0]) == best
    want = [sum(w for p, w in zip(paths, weight) if p[i] == best[i]) / weight.sum() for i in range(5)]
    assert np.allclose(marginal[0], want, atol=1e-4)


def test_reconciled_is_the_heaviest_choice():
    rs = random.Random(3)
    for _ in range(200):
        spans = [(a := rs.randint(0, 12), a + rs.randint(1, 6), rs.randint(0, 2), rs.choice([1.0, 0.5, 0.25])) for _ in range(7)]
        found = reconciled(spans)
        assert all(x[1] <= y[0] for x, y in zip(found, found[1:]))
        weight = {(a, b, k): max(w for p, q, r, w in spans if (p, q, r) == (a, b, k)) for a, b, k, _ in spans}
        best = max(
            sum(weight[s] for s in some)
            for n in range(len(weight) + 1)
            for some in itertools.combinations(sorted(weight), n)
            if all(x[1] <= y[0] for x, y in zip(some, some[1:]))
        )
        assert abs(sum(weight[s] for s in found) - best) < 1e-9


@pytest.fixture(scope="module")
def tagger():
    rs = random.Random(0)
    made = [f"{prose(i, 30)} mail{i}@host{i % 9}.example.com {prose(50 + i, 20)} +1 ({rs.randint(100, 999)}) 555-{rs.randint(1000, 9999)} end" for i in range(40)]
    return train_tagger(made, steps=500, examples=2000)


def test_tagger_finds_spans_that_the_patterns_miss(tagger):
    numbers = [f"({a}) 555-{b}" for a, b in ((217, 7713), (345, 1290), (918, 4021), (402, 8813), (660, 1507), (731, 9924))]
    found = Finder(tagger).find([f"{prose(i, 9)} call {n} now, {prose(i + 9, 9)}" for i, n in enumerate(numbers)])
    assert sum(len(added) for _, added in found) >= 3
    assert all(not base for base, _ in found)


def test_windows_without_an_anchor_add_nothing(tagger):
    texts = [prose(i, 300) for i in range(5)]
    assert Finder(tagger).find(texts) == [([], [])] * 5


def test_added_spans_never_touch_base_spans_and_long_texts_are_covered(tagger):
    text = prose(1, 20_000) + " x@y.example.com, " + prose(2, 20_000) + " call (217) 555-7713 and +1 (345) 555-1290."
    (base, added), = Finder(tagger).find([text])
    assert base == plain_spans(text)
    assert all(b <= x or a >= y for _, a, b in added for _, x, y in base)


class CapitalTagger:
    """Tags runs of capitals, dots and brackets as addresses, as far as the window shows them."""

    def decode(self, x):
        inside = ((x >= ord("A") - 32) & (x <= ord("Z") - 32)) | np.isin(x, [ord(c) - 32 for c in ".()"])
        first = inside.copy()
        first[:, 1:] &= ~inside[:, :-1]
        first[:, 0] = False  # goes on from the window before
        return np.where(first, 1, np.where(inside, 2, 0)), np.where(inside, 0.95, 1.0)


def test_long_spans_are_found_wherever_they_stand():
    plain = "lorem ipsum " * 20
    for length in (12, 31, 40, 50, 60, 64, 80, 130, 200):
        for left in (length // 2, 3, length - 9):
            span = f"{'N' * left}(AT){'H' * max(2, length - left - 8)}.ORG"
            texts = [f"{plain[:i]} {span} {plain}" for i in range(80, 80 + 32)]
            for i, (base, added) in zip(range(80, 80 + 32), Finder(CapitalTagger()).find(texts)):
                assert not base and added == [("email", i + 1, i + 1 + len(span))], (length, left, i)


def test_implausible_and_base_overlapping_spans_do_not_displace_good_ones(monkeypatch):
    text = "call (217) 555-7713 or write to x@y.example.com now"
    phone, mail = (text.index("("), text.index(" or")), (text.index("x@"), text.index(" now"))
    found = [(phone[0] - 5, phone[1], 3, 0.99), (*phone, 3, 0.95), (phone[0], mail[1], 0, 0.999)]
    monkeypatch.setattr(personal, "joined_pieces", lambda pieces, n, longest: [found])
    assert Finder(None).find([text]) == [([("email", *mail)], [("phone", *phone)])]


def test_spans_beyond_the_longest_are_not_added():
    span = f"{'N' * 40}(AT){'H' * 40}.ORG"
    text = f"{'lorem ipsum ' * 10}{span} {'lorem ipsum ' * 10}"
    assert len(Finder(CapitalTagger(), len(span)).find([text])[0][1]) == 1
    assert Finder(CapitalTagger(), len(span) - 1).find([text])[0][1] == []


@pytest.fixture(scope="module")
def production_tagger(spark):
    return train(spark.read.parquet(f"{SMALL_SF}/documents.parquet"))


def _unseen(rs):
    """Forms that the generator of training windows never makes, by kind."""
    d = lambda n: "".join(str(rs.randint(0, 9)) for _ in range(n))
    names = "jane.doe j_smith maria-k x.y+tag info99 the.boss".split()
    hosts = "mail-host.co.uk uni.edu site.io dept.example.de x1.my-shop.store4u.fr".split()
    luhn_card = lambda n: next(b + c for b in [d(n - 1)] for c in "0123456789" if personal.luhn(b + c))
    amex, visa = luhn_card(15), luhn_card(16)
    return {
        "phone": [f"({d(3)}) {d(3)} {d(4)}", f"1-{d(3)}-{d(3)}-{d(4)}", f"{d(3)} {d(3)} {d(4)}", f"0{d(2)} {d(4)} {d(4)}", f"({d(4)}) {d(6)}", f"{d(3)}.{d(3)}-{d(4)}"],
        "email": [f"{rs.choice(names)}(At){rs.choice(hosts)}", f"{rs.choice(names)} (at){rs.choice(hosts)}", f"{rs.choice(names)}[At] {rs.choice(hosts)}", f"{rs.choice(names)}[at]{rs.choice(hosts)}"],
        "ip": [f"{rs.randint(1, 255)}[.]{rs.randint(0, 255)}.{rs.randint(0, 255)}[.]{rs.randint(0, 255)}", f"{rs.randint(1, 255)}.{rs.randint(0, 255)}.{rs.randint(0, 255)}[.]{rs.randint(0, 255)}"],
        "card": [f"{amex[:4]}.{amex[4:10]}.{amex[10:]}", f"{visa[:4]}/{visa[4:8]}.{visa[8:12]}/{visa[12:]}", f"{amex[:4]}/{amex[4:10]}/{amex[10:]}"],
    }


def test_recall_on_forms_that_training_does_not_make(production_tagger):
    """Over half of every kind, at least four fifths in all, and no plain number taken."""
    rs = random.Random(11)
    made = [(kind, form) for _ in range(25) for kind, forms in _unseen(rs).items() for form in forms]
    texts, spans = [], []
    for i, (kind, form) in enumerate(made):
        left = f"{prose(i, 12)[:-1]} "
        texts.append(f"{left}{form} {prose(i + 7, 12)}")
        spans.append((kind, len(left), len(left) + len(form)))
    found = Finder(production_tagger).find(texts)
    assert all(span not in base for span, (base, _) in zip(spans, found))
    hit = {kind: [span in added for span, (_, added) in zip(spans, found) if span[0] == kind] for kind in personal.KINDS}
    share = {kind: sum(x) / len(x) for kind, x in hit.items()}
    print("recall on unseen forms:", share)
    assert all(x >= 0.5 for x in share.values()), share
    plain = [f"{prose(i, 12)} {n} {prose(i + 5, 12)}" for i, n in enumerate(["12.5", "1,234.50", "2024-05-06", "17:45", "#48213", "v2.10.3", "90210", "3/4", "1e-9", "0x1f9a"] * 10)]
    assert sum(len(added) for _, added in Finder(production_tagger).find(plain)) == 0


def test_edge_rows_with_a_trained_tagger(edge_docs, edge_rows, no_docs, tagger):
    rows = personal_data(edge_docs, tagger).collect()
    assert len(rows) == len(edge_rows)
    finder = Finder(tagger)
    want = sorted(((r[0], joined(sorted(b + a, key=lambda s: (s[1], personal.KINDS.index(s[0]))))) for r in edge_rows for b, a in finder.find([r[1] or ""])), key=repr)
    assert sorted(((r["doc_id"], r["spans"]) for r in rows), key=repr) == want
    assert personal_data(no_docs, tagger).collect() == []


def test_edge_rows(edge_docs, edge_rows, no_docs):
    rows = personal_data(edge_docs, None).collect()
    assert len(rows) == len(edge_rows)
    empty = hashlib.sha256(b"").hexdigest()
    by_id = {r["doc_id"]: r for r in rows}
    for i in (4, 5, 6):
        assert (by_id[i]["base_sha256"], by_id[i]["spans"], by_id[i]["n_email"]) == (empty, "", 0)
    assert personal_data(no_docs, None).collect() == [] and train(no_docs) is None


def test_digest_columns(spark):
    text = "a@b.cc 1.2.3.4 and +12 345 678 9012"
    row = personal_data(spark.createDataFrame([(1, text)], "doc_id long, text string"), None).first()
    want = joined(plain_spans(text))
    assert (row["spans"], row["base_sha256"]) == (want, hashlib.sha256(want.encode()).hexdigest())
    assert (row["n_email"], row["n_ip"], row["n_card"], row["n_phone"]) == (1, 1, 0, 1)
