"""Operators 7 and 9 against brute force."""

import random
from collections import defaultdict

import numpy as np
import pytest

from tunefold.llm import neardup, spans
from tunefold.llm.queries import op9_minhash_near_duplicates


def _set(text, k):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def _components(texts, k, percent):
    sets = {i: _set(t, k) for i, t in texts.items()}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = defaultdict(list)
    for i in sorted(sets):
        common = defaultdict(int)
        for g in sets[i]:
            for j in holders[g]:
                common[j] += 1
            holders[g].append(i)
        for j, c in common.items():
            if 100 * c >= percent * (len(sets[i]) + len(sets[j]) - c):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (find(i), len(s)) for i, s in sets.items()}


def _got(df):
    rows = df.collect()
    assert all(r.kept == (r.component_id == r.doc_id) for r in rows if r.doc_id is not None)
    return {r.doc_id: (r.component_id, r.n_shingles) for r in rows}


def test_near_duplicates_equal_brute_force(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert _got(op9_minhash_near_duplicates(spark, sf)) == _components(texts, 3, 85)


def test_large_group_of_near_copies(docs_of):
    """A group whose similarities lie on both sides of the threshold, with copies of copies: no link is lost."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(160)]
    texts = {}
    for i in range(260):
        w = list(texts[rng.randrange(i)].split()) if i and rng.random() < 0.5 else list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 6, 12])):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        texts[i] = " ".join(w)
    assert _got(neardup.near_duplicates(docs_of(texts.items()), k=3, percent=85)) == _components(texts, 3, 85)


def test_near_duplicates_odd_rows(docs_of):
    texts = {1: None, 2: "", 3: " \n", 4: "One two", 5: "one  TWO", 6: "one", 7: "z " * 50_000, 8: "z " * 60_000, 9: "É x y", 10: "é x y"}
    df = docs_of(texts.items(), component_id=1, kept=False)
    assert _got(neardup.near_duplicates(df, k=3, percent=85)) == _components(texts, 3, 85)
    assert neardup.near_duplicates(docs_of([])).count() == 0
    rows = neardup.near_duplicates(docs_of([(None, "a b c"), (5, "a b c"), (5, "a b c")]), k=3).collect()
    assert sorted((r.doc_id or 0, r.component_id, r.kept) for r in rows) == [(0, None, True), (5, 5, True), (5, 5, True)]


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(100, 70), (70, 60)], "u long, v long")
    found = {r.node: r.component for r in neardup.components(links).collect()}
    assert found == {i: 0 for i in range(51)} | {60: 60, 70: 60, 100: 60}


def test_bands_miss_a_pair_at_the_threshold_with_the_stated_chance():
    for t in (0.8, 0.85):
        assert (1 - t**neardup.ROWS) ** neardup.band_count(t) <= neardup.MISS


PASSAGE = (
    "The committee met twice in spring and once in autumn. Its report was long and dull. Nobody read the second part of it, "
    "but everybody quoted the first one with great pleasure at dinner. In the end the mayor lost the only copy that was "
    "signed. A clerk found it years later under a cupboard, when the office was moved to another street."
)


def _own(n, seed):
    rng = random.Random(seed)
    return " ".join(f"{rng.choice('bdfgklm')}{rng.randrange(10**5)}" + (". " if rng.random() < 0.15 else "") for _ in range(n)).replace(" .", ".") + "."


def test_repeated_passages_go_from_all_but_the_first(docs_of):
    texts = {i: f"{_own(60, i)}\n{PASSAGE if i % 2 else PASSAGE.upper()}\n{_own(40, 100 + i)}" for i in range(6)}
    texts |= {10: _own(200, 10), 11: f"{PASSAGE} {_own(30, 11)} {PASSAGE}"}
    rows = {r.doc_id: r for r in spans.deduplicated(docs_of(texts.items())).collect()}
    assert rows[0].text == texts[0] and rows[10].text == texts[10]
    for i in range(1, 6):
        assert rows[i].text.split() == f"{_own(60, i)} {_own(40, 100 + i)}".split(), i
        assert rows[i].removed_words == len(PASSAGE.split())
    assert rows[11].text.split() == _own(30, 11).split()


def test_covered_units_equal_brute_force():
    """Units in a repeated run, by a plain search over all runs of units."""
    rng = random.Random(9)
    sentences = [_own(rng.randint(1, 30), 200 + k).replace(". ", " ") for k in range(12)]
    texts = [" ".join(rng.choices(sentences, k=rng.randint(2, 8))) for _ in range(12)]

    def units(t):
        out, now = [], []
        for w in t.split():
            now.append(w)
            if w[-1] in ".!?" or len(now) == spans.UNIT:
                out.append(now)
                now = []
        return out + ([now] if now else [])

    def runs(us):
        for a in range(len(us)):
            for b in range(a + 2, len(us) + 1):
                n = lambda x, y: sum(map(len, us[x:y]))
                if n(a, b) >= spans.WORDS and (b - a == 2 or n(a, b - 1) < spans.WORDS or n(a + 1, b) < spans.WORDS):
                    yield a, b, tuple(w for u in us[a:b] for w in u)

    seen: set = set()
    for t in texts:
        us, gone, mine = units(t), set(), set()
        for a, b, key in sorted(runs(us), key=lambda r: (r[0], r[1])):
            if key in seen or key in mine:
                gone |= set(range(a, b))
            mine.add(key)
        want = [w for k, u in enumerate(us) if k not in gone for w in u]
        u = spans.Units([t.encode()])
        keys = {}
        for a, b, one, two in zip(u.a.tolist(), u.b.tolist(), u.one.tolist(), u.two.tolist()):
            keys[one, two] = tuple(w for x in us[a:b] for w in x)
        assert set(keys.values()) == {k for _, _, k in runs(us)}
        left = spans.without(t.encode(), {h for h, k in keys.items() if k in seen})[0]
        assert left.decode().split() == want
        seen |= mine


def test_spans_odd_rows(docs_of):
    texts = [(1, None), (2, ""), (None, PASSAGE), (4, PASSAGE), (4, PASSAGE), (5, PASSAGE), (6, "x " * 40_000), (7, "one. two.")]
    rows = spans.deduplicated(docs_of(texts, one="x", removed=1)).collect()
    by = defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r.text)
    assert by[1] == [None] and by[2] == [""] and by[None] == [PASSAGE] and by[4] == [PASSAGE, PASSAGE] and by[5] == [""]
    assert by[7] == ["one. two."] and len(by[6][0]) < 200 and rows[0].one == "x"
    assert spans.deduplicated(docs_of([])).count() == 0


def test_long_texts_are_handled_in_parts(monkeypatch):
    monkeypatch.setattr(spans, "PART", 1000)
    text = (_own(400, 1)).encode()
    assert b"".join(spans.parts(text)) == text and len(spans.parts(text)) > 2
    assert spans.without(text, set())[0] == text
    assert np.concatenate([spans.Units([p]).one for p in spans.parts(text)]).size


def _words(n, seed):
    rng = random.Random(seed)
    return [f"{rng.choice('bdfgklm')}{rng.randrange(10**6)}" for _ in range(n)]


def _dedup(texts):
    """Removed words of each text, the first of which keeps all."""
    found, gone, out = set(), set(), []
    for t in texts:
        u = spans.Units([t.encode()])
        mine = set(zip(u.run_one.tolist(), u.run_two.tolist()))
        out.append(spans.without(t.encode(), mine & found)[1])
        found |= mine
    return out


def test_long_sentences_repeat_wherever_they_begin():
    shared = _words(62, 1)
    texts = [" ".join(shared) + ".", " ".join(["more", *shared]) + ".", " ".join([*_words(9, 2), *shared[5:], *_words(9, 3)])]
    texts += [" ".join([*_words(30, 4), *shared[:30], "new", *shared[30:], *_words(30, 5)])]
    removed = _dedup(texts)
    assert removed[0] == 0 and all(n >= 36 for n in removed[1:3]) and removed[3] >= 20
    rng = random.Random(6)
    first = " ".join(_words(4000, 7))
    w = first.split()
    total = left = 0
    for k in range(60):
        a, n = rng.randrange(3900), 60 + k
        n = min(n, 4000 - a)
        left += n - min(n, _dedup([first, " ".join([*_words(rng.randrange(40), 100 + k), *w[a : a + n], *_words(20, 200 + k)])])[1])
        total += n
    assert left < 0.25 * total


def test_quoted_and_other_scripts_sentences_end():
    for stop in ('."', ".)", ".”", "?»", "。", "！", "।", "؟", "…)", ".'\")"):
        t = f"one two{stop} three four five.6 six"
        u = spans.Units([t.encode()])
        assert u.unit.tolist() == [0, 2], stop
    assert spans.Units(["a ) b” . c".encode()]).unit.tolist() == [0, 4]


def test_runs_cross_the_edges_of_parts(monkeypatch):
    text, passage = " ".join(_words(900, 1)), " ".join(_words(50, 2))
    monkeypatch.setattr(spans, "PART", 2000)
    for at in range(0, 2200, 97):
        t = f"{text[:at]} {passage} {text[at:]}".encode()
        assert spans.without(t, set())[0] == t
        u = spans.Units([passage.encode()])
        cut, words, _ = spans.without(t, set(zip(u.run_one.tolist(), u.run_two.tolist())))
        assert words >= 30 and len(cut.split()) == 950 + (at > 0 and text[at - 1] != " " and text[at] != " ") - words, at


def test_every_row_of_the_leading_id_is_kept(docs_of):
    words = [f"w{i}" for i in range(200)]
    near = " ".join([*words[:199], "other"])
    rows = neardup.judged(docs_of([(7, " ".join(words)), (7, near), (9, near)]), k=3, percent=85).collect()
    assert {(r.doc_id, r.component_id, r.kept) for r in rows} == {(7, 7, True), (9, 7, False)}
    assert sum(r.stays for r in rows) == 1


def _check_dedup(docs_of, texts, **extra):
    rows = spans.deduplicated(docs_of(texts.items(), **extra)).collect()
    want = dict(zip(sorted(texts), _dedup([texts[i] for i in sorted(texts)])))
    assert {r.doc_id: r.removed_words for r in rows} == want and len(rows) == len(texts)
    return rows


@pytest.mark.parametrize("met", [0, 40, 500_000])
def test_a_passage_in_a_third_of_all_documents(docs_of, monkeypatch, met):
    """Whatever a task remembers; documents in any order, several batches a task."""
    monkeypatch.setattr(spans.Met.__init__, "__defaults__", (met,))
    rng = random.Random(met)
    texts = {i: f"{_own(30, i)} {PASSAGE if i % 3 == 1 else _own(25, i % 7)} {_own(20, 900 + i)}" for i in rng.sample(range(2000), 150)}
    _check_dedup(docs_of, texts)


def test_a_task_remembers_the_least_document():
    one, two = np.array([5, 9], np.int64), np.array([1, 2], np.int32)
    met = spans.Met(3)
    assert met.known(one, two, np.array([4, 4])).tolist() == [False, False]
    met.add(one, two, np.array([4, 4]))
    assert met.known(one, np.array([1, 7], np.int32), np.array([6, 6])).tolist() == [True, False]
    assert met.known(one, two, np.array([2, 4])).tolist() == [False, False]  # a lesser one, and the same one
    assert met.known(one, two, np.array([3, 3])).tolist() == [True, False]
    met.add(one + 1, two, np.array([1, 1]))  # over the bound: earlier runs are forgotten
    assert met.known(one, two, np.array([9, 9])).tolist() == [False, False] and len(met.one) == 2


def test_spans_run_on_their_own_output_and_clashing_names(docs_of):
    texts = {i: f"{_own(30, i)} {PASSAGE}" for i in range(4)}
    once = spans.deduplicated(docs_of(texts.items(), __doc=1, __gone="x", one=2, first=3))
    again = spans.deduplicated(once).collect()
    assert {(r.doc_id, r.text, r["__doc"], r["__gone"]) for r in again} == {(r.doc_id, r.text, 1, "x") for r in once.collect()}
    assert [r.removed_words for r in again] == [0] * 4 and once.columns == spans.deduplicated(once).columns
