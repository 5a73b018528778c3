import random
import re
from collections import Counter

import numpy as np
import pytest

from rolemill.llm import automaton, components, ngram_join, packing, prefix_free, repeat_removal, rtree, secrets, textarrays
from rolemill.llm.automaton import combined, compiled, parsed


def brute_spans(text):
    found = []
    for i, r in enumerate(secrets.RULES):
        flags = (re.I if r.fold else 0) | re.A
        for m in re.finditer(f"({r.head})({r.body})", text, flags):
            if len(re.fullmatch(f"(?P<h>{r.head})(?P<b>{r.body})", m[0], flags)["b"]) >= r.least:
                found.append((m.start(), i, r.kind, m.end()))
    return [(s, k, e) for s, _, k, e in sorted(found)]


def test_secrets_match_brute_force():
    rng = random.Random(3)
    bits = ["password", "SECRET", "token", "api_key", "=", ":", " ", '"', "'", "abcdef0123456789", "AKIA", "ABCDEFGHIJ12345", "ghp_", "x" * 30, "é", "eyJ", ".", "AIza", "-----BEGIN ", "RSA ", "PRIVATE KEY-----", "xoxb-", "0123", "\n", "日本"]
    texts = ["", " "] + ["".join(rng.choice(bits) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    assert list(secrets.Detector().texts([t.encode() for t in texts])) == [brute_spans(t) for t in texts]


@pytest.mark.parametrize("size", [64, 4096])
def test_blocks_go_on_in_the_state_of_the_one_before(monkeypatch, size):
    monkeypatch.setattr(automaton, "BLOCK", size)
    monkeypatch.setattr(automaton, "LANES", size // 32)
    rng = random.Random(4)
    text = "".join(rng.choice(["password=", "abcdef0123456789", "x", " ", "AKIA", "ABCDEFGHIJ12345", "é"]) for _ in range(3000))
    assert list(secrets.Detector().texts([text.encode(), b"", text.encode()])) == [brute_spans(text), [], brute_spans(text)]


def test_long_text_is_scanned_whole():
    text = "word " * 600_000 + "password=abcdefghijklmnop"
    assert list(secrets.Detector().texts([text.encode()])) == [[(3_000_000, "assign", 3_000_025)]]


@pytest.mark.parametrize("pattern", ["a(b|c)*d", "x{2,4}y?", "[^a-c]+z", r"\x41\.?", "(ab|a)(c|bcd)"])
def test_automaton_agrees_with_re(pattern):
    rng, dfa = random.Random(1), compiled(parsed(pattern))
    classes, table, accepts = dfa.rows()
    for _ in range(500):
        text = "".join(rng.choice("abcdxyzA.") for _ in range(rng.randint(0, 7)))
        state = 0
        for b in text.encode():
            state = table[state][classes[b]]
        assert bool(accepts[state]) == bool(re.fullmatch(pattern, text))
    assert combined([parsed(pattern), parsed("q")]).accepts.max() <= 3


def test_word_hashes_follow_words():
    text = " a bb\t\x0ba  ccc\nbb é\xa0é "
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    hashes = textarrays.word_hashes(text.encode()).tolist()
    assert len(hashes) == len(words) and all((x == y) == (a == b) for x, a in zip(hashes, words) for y, b in zip(hashes, words))
    assert len(textarrays.word_hashes(b"")) == len(textarrays.word_hashes(b" \n")) == 0


def test_prefix_free_order_finds_repeats():
    rng = random.Random(5)
    for length in (5, 20):
        base = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 90))).encode() for _ in range(6)]
        texts = base + [base[0][10:60] + b"x" + base[1], b"ab" * 40]
        live = [max(0, len(t) - length + 1) for t in texts]
        counts = Counter(t[i : i + length] for t, n in zip(texts, live) for i in range(n))
        longer = Counter(t[i : i + length + 7] for t in texts for i in range(len(t) - length - 6))
        got = prefix_free.repeated(texts, live, (length, length + 7))
        assert [g.tolist() for g, _ in got] == [[counts[t[i : i + length]] > 1 for i in range(n)] for t, n in zip(texts, live)]
        assert [g.tolist() for _, g in got] == [[longer[t[i : i + length + 7]] > 1 for i in range(n)] for t, n in zip(texts, live)]


@pytest.mark.parametrize("size", [repeat_removal.SLICE, 100, 7])
def test_anchors_cover_each_start_once_and_agree(monkeypatch, size):
    monkeypatch.setattr(repeat_removal, "SLICE", size)
    rng = np.random.default_rng(2)
    shared = rng.integers(97, 101, 700, np.uint8).tobytes()
    a, b = rng.integers(97, 101, 900, np.uint8).tobytes() + shared, shared + rng.integers(97, 101, 300, np.uint8).tobytes()
    keys = {}
    for n, t in enumerate((a, b)):
        key, at, first, last = repeat_removal.anchors(t)
        assert first[0] == 0 and last[-1] == len(t) - 300 and (first[1:] == last[:-1] + 1).all()
        for k, p, lo, hi in zip(key, at, first, last):
            for i in range(lo, hi + 1):
                keys.setdefault(t[i : i + 300], set()).add((int(k), int(p - i)))
    assert all(len(x) == 1 for x in keys.values())


def test_components_are_whole_in_small_forests(monkeypatch):
    rng = random.Random(4)
    monkeypatch.setattr(components, "HELD", 20)
    monkeypatch.setattr(components, "FOREST", 30)
    links = sorted({tuple(sorted(rng.sample(range(150), 2), reverse=True)) for _ in range(110)})

    def roots(pairs):
        up = {}
        for a, b in pairs:
            low, high = sorted((up.setdefault(a, a), up.setdefault(b, b)))
            up = {k: low if v == high else v for k, v in up.items()}
        return up

    for size in (1, 7, 110):
        batches = [components._rows(*np.array(links[i : i + size], np.int64).T) for i in range(0, len(links), size)]
        out = [r for batch in components._contracted(iter(batches)) for r in batch.to_pylist()]
        left = [(r["a"], r["b"]) for r in out if r["a"] is not None]
        assert roots(left) == roots(links) and all(a > b for a, b in left)
        assert any(r["moved"] for r in out)  # some node points at several others
    whole = components.forest(*np.array(links, np.int64).T)
    assert {int(a): int(b) for a, b in zip(*whole)} == {a: b for a, b in roots(links).items() if a != b}


def test_rtree_reaches_all_similar_sets():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 2**64, rng.integers(1, 400), np.uint64)) for _ in range(60)]
    sets += [np.unique(np.append(s[rng.random(len(s)) > 0.04], rng.integers(0, 2**64, 3, np.uint64))) for s in sets for _ in range(2)]

    def brute(percent):
        root = list(range(len(sets)))
        for i in range(len(sets)):
            for j in range(i):
                if rtree.similar(sets[i], sets[j], percent):
                    a, b = sorted((root[i], root[j]))
                    root = [a if r == b else r for r in root]
        return root

    sizes = np.array([len(s) for s in sets])
    points = [rtree.point(s, rtree.fine_groups(len(s))).astype(np.uint16) for s in sets]
    for percent in (70, 85):
        loose = rtree.Groups(len(sets))
        for i, j in rtree.reachable_links(points, sizes, percent):
            loose.join(i, j)
        assert all(loose.root[i] == loose.root[j] for i in range(len(sets)) for j in range(i) if rtree.similar(sets[i], sets[j], percent))
        groups = rtree.Groups(len(sets))
        for i, j in rtree.spanning_links(sets, percent):
            assert rtree.similar(sets[i], sets[j], percent)
            groups.join(i, j)
        want = brute(percent)
        assert [[groups.root[i] == groups.root[j] for j in range(len(sets))] for i in range(len(sets))] == [[want[i] == want[j] for j in range(len(sets))] for i in range(len(sets))]


def test_linked_sets_share_a_first_member():
    rng = np.random.default_rng(6)
    counts = rng.integers(0, 50, ngram_join.SKETCH)
    for n in (1, 3, 7, 20, 300):
        a = np.unique(rng.integers(0, 2**64, n, np.uint64))
        b = np.unique(np.append(a[: max(1, int(n * 0.93))], rng.integers(0, 2**64, n // 30, np.uint64)))
        if rtree.similar(a, b, 85):
            assert set(ngram_join.first_members(a, 85, counts)) & set(ngram_join.first_members(b, 85, counts))


def test_linked_sets_share_a_pair_of_members():
    rng = np.random.default_rng(7)
    counts = rng.integers(0, 5, ngram_join.SKETCH)
    often = np.full(ngram_join.OFTEN, 255, np.uint8)  # every member is one that many sets have
    tried = 0
    for percent in (30, 60, 85):
        for n in (1, 2, 3, 4, 7, 20, 120):
            for _ in range(30):
                a = np.unique(rng.integers(0, 2**64, n, np.uint64))
                b = np.unique(np.append(a[rng.random(len(a)) < 0.9], rng.integers(0, 2**64, n // 9 + 1, np.uint64)))
                if len(b) and rtree.similar(a, b, percent) and not np.array_equal(a, b):
                    tried += 1
                    assert set(ngram_join.paired_members(a, percent, counts, often)) & set(ngram_join.paired_members(b, percent, counts, often))
    assert tried > 100 and not len(ngram_join.paired_members(a, 85, counts, np.zeros(ngram_join.OFTEN, np.uint8)))


@pytest.mark.parametrize("size", [1, 2, 3, 4, 5, 7, 100])
def test_long_runs_stay_whole_across_batches(size):
    runs = {1: 2, 2: 13, 3: 1, 4: 4, 5: 3, 6: 9, 7: 2}
    rows = np.array([(k, 100 * k + i) for k, n in runs.items() for i in range(n)], np.int64)
    batches = [ngram_join._table({"key": x[:, 0], "sid": x[:, 1]}) for x in (rows[i : i + size] for i in range(0, len(rows), size))]
    for often in (True, False):
        links, teams = {}, {}
        for batch in ngram_join._shared(3, often)(iter(batches)):
            for r in batch.to_pylist():
                (teams if r["other"] is None else links).setdefault(r["team"] if r["other"] is None else r["sid"], set()).add(r["sid"] if r["other"] is None else r["other"])
        long = {k: n for k, n in runs.items() if n > 3}
        assert links == ({k: {k} for k in long} if often else {100 * k: {100 * k + i for i in range(1, n)} for k, n in long.items()})
        assert sorted(map(sorted, teams.values())) == [[100 * k + i for i in range(n)] for k, n in runs.items() if 1 < n <= 3]


def test_packing_keeps_all_and_overfills_nothing():
    rng = np.random.default_rng(8)
    sizes = np.sort(rng.integers(1, 4097, 3000))[::-1]
    plan = packing.packed(sizes)
    held = np.bincount(plan.bins, sizes)
    assert (held == plan.held).all() and (held <= plan.capacities).all() and set(plan.capacities) <= set(packing.LENGTHS)
    ends = sorted(zip(plan.bins, plan.offsets, sizes))
    assert all(b != c or o + s == p for (b, o, s), (c, p, _) in zip(ends, ends[1:]))
    assert held.sum() / plan.capacities.sum() > 0.97
    smaller = np.array(packing.LENGTHS)
    assert all(h > smaller[smaller < c].max(initial=0) for h, c in zip(held, plan.capacities))
    assert packing.packed(np.zeros(0, np.int64)).cost() == 0


def test_packing_costs_what_naive_best_fit_costs():
    rng = np.random.default_rng(9)

    def naive(sizes, menu):
        bins, left = [], int(sum(sizes))  # (room, held)
        for size in sizes:
            fitting = [k for k, (room, _) in enumerate(bins) if room >= size]
            if fitting:
                k = min(fitting, key=lambda k: bins[k][0])
                bins[k] = (bins[k][0] - size, bins[k][1] + size)
            else:
                length = min((c for c in menu if c >= size), key=lambda c: ((c + packing.OPENING) / min(c, left), c))
                bins.append((length - size, size))
            left -= size
        return sum(min(c for c in packing.LENGTHS if c >= held) + packing.OPENING for _, held in bins)

    for n in (1, 7, 60, 400):
        sizes = np.sort(rng.integers(1, 4097, n))[::-1]
        menus = [packing.LENGTHS[k:] for k in range(4)] + [(c, 4096) for c in packing.LENGTHS[:-1]]
        assert packing.packed(sizes).cost() <= min(naive(sizes.tolist(), m) for m in menus) * 1.01
        for menu in menus:
            assert abs(packing.downsized(packing.best_fit(sizes, menu), packing.LENGTHS).cost() / naive(sizes.tolist(), menu) - 1) < 0.02
