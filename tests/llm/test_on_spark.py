"""Each operator over one small table with nulls, empty and long texts, ties, repeated rows and clashing extra columns."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest

from rolemill import shared
from rolemill.llm import components, exact_dedup, language_id, lm_scoring, mixing, ngram_join, packing, quality_classifier, quality_rules, repeat_removal, secrets
from rolemill.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, key string, kept boolean, n_words string, digest int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def made_rows():
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.choice([5, 60, 120, 300]))) for _ in range(40)]
    passage = " ".join(rng.choice(words) for _ in range(110))
    near = texts[1].split()
    fifty = " ".join(rng.choice(words) for _ in range(60))  # under 400 bytes
    texts += [texts[5] + " " + fifty, fifty + " " + texts[6]]
    texts += [texts[0], texts[0].replace(" ", "\n"), " ".join(near[:-2]) + " zz yy", texts[2] + " " + passage, passage + " " + texts[3], None, "", " \t\n", "Straße é 日本 token=abcdefghijklmn", "x " * 300, "a b a b", " ".join(rng.choice(words) for _ in range(9000))]
    rows = [(i, t, rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "s2", "s2", None])) for i, t in enumerate(texts)]
    rows += [rows[4], rows[4]]
    return [(i, t, lang, source, len(t or ""), -1, "k", None, "w", 0) for i, t, lang, source in rows]


@pytest.fixture(scope="module")
def rows():
    return made_rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_exact_dedup(docs, none, rows):
    groups = defaultdict(list)
    for r in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "")].append(r[0])
    want = sorted((i, min(ids), len(ids)) for ids in groups.values() for i in ids)
    for digest in (exact_dedup.sha256, lambda t: exact_dedup.F.substring(exact_dedup.sha256(t), 1, 0)):  # the second one always clashes
        got = exact_dedup.deduplicated(docs, digest).collect()
        assert sorted((r.doc_id, r.keep_id, r.group_size) for r in got) == want
        assert sorted(r.doc_id for r in got if r.kept) == sorted(min(ids) for ids in groups.values())
    assert exact_dedup.kept_documents(docs).count() == len(groups)
    assert exact_dedup.kept_documents(docs).columns == docs.columns
    assert exact_dedup.deduplicated(none).count() == 0


def test_state_goes_on_where_it_ended(spark, docs, tmp_path):
    plan = exact_dedup.digest_rows(docs)
    plan.where("doc_id % 2 = 1").write.parquet(f"{tmp_path}/in")
    first = exact_dedup.run_stream(spark, f"{tmp_path}/in", plan.schema, f"{tmp_path}/state", 1).count()
    plan.where("doc_id % 2 = 0").write.mode("append").parquet(f"{tmp_path}/in")
    both = exact_dedup.run_stream(spark, f"{tmp_path}/in", plan.schema, f"{tmp_path}/state", 1)
    want = {r["digest"]: (r["first"].doc_id, r["group_size"]) for r in exact_dedup.keyed_state(plan).collect()}
    assert first < len(want) and {r["digest"]: (r["first"].doc_id, r["group_size"]) for r in both.collect()} == want


def test_quality_rules(docs, none, rows):
    got = {r.doc_id: r for r in quality_rules.judged(docs).collect()}
    for i, text, *_ in rows:
        w = WORD.findall(text or "")
        times = Counter(zip(w, w[1:], w[2:]))
        inside = {k for j, x in enumerate(zip(w, w[1:], w[2:])) if times[x] > 1 for k in (j, j + 1, j + 2)}
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        assert (got[i].n_words, got[i].word_chars, got[i].n_repeat_words, got[i].n_dup_lines) == (len(w), sum(map(len, w)), len(inside), len(lines) - len(set(lines)))
        assert got[i].base_failed == (len(w) < 50 or 100 * len(inside) > 50 * len(w))
    left = quality_rules.passing(docs)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == {i for i in got if got[i].kept}
    assert quality_rules.passing(none).count() == 0
    plan = left._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("xxhash64") == 1 and plan.count("array_distinct") == 2  # no count is computed twice


def test_mixing(docs, none, rows):
    got = mixing.drawn(docs).collect()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(WORD.findall(r[1] or ""))
    assert len(got) == len(rows) and sum(r.target for r in {r.source: r for r in got}.values()) == pytest.approx(1.5 * sum(sizes.values()))
    for s in sizes:
        own = [r for r in got if r.source == s]
        assert {r.source_size for r in own} == {sizes[s]} and all(0 <= r.taken <= 2 * r.size for r in own)
        assert own[0].target <= 2 * sizes[s] + 1e-6
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(r.size for r in own)
    again = mixing.drawn(docs.repartition(5)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    assert mixing.mixed(docs).count() == sum(r.copies for r in got) and mixing.mixed(docs).columns == docs.columns
    assert mixing.drawn(none).count() == 0


def test_mixing_tells_repeated_rows_apart(spark):
    for texts in (["a b c"] * 300, [f"{'#$% ' * (i % 7)}w{i} b c" for i in range(300)]):
        docs = spark.createDataFrame([(7, "s", t) for t in texts] + [(None, "t", t) for t in texts], "doc_id long, source string, text string").repartition(3)
        rows = mixing.drawn(docs).collect()
        for source in "st":
            own = [r for r in rows if r.source == source]
            assert abs(sum(r.taken for r in own) - own[0].target) <= max(r.size for r in own)
        assert Counter(map(tuple, rows)) == Counter(map(tuple, mixing.drawn(docs.repartition(5)).collect()))


def test_bands_are_even_whatever_the_weights(spark):
    docs = spark.range(20_000).select(mixing.F.col("id").alias("doc_id"), mixing.F.lit("s").alias("source"), mixing.F.lit("#$% #$% a").alias("text"))
    bands = mixing.banded(mixing.keyed(docs), 64).groupBy("band").count().collect()
    assert len(bands) == 64 and max(r["count"] for r in bands) < 2 * 20_000 / 64


def test_packing_spreads_rows_with_one_id(spark):
    docs = spark.createDataFrame([(i, "w " * 100) for i in [5] * 300 + [None] * 300 + [2**60 + 1]], "doc_id long, text string").repartition(2)
    rows = packing.packed_documents(docs, shard_tokens=3000).collect()
    assert Counter(r.doc_id for r in rows) == {5: 300, None: 300, 2**60 + 1: 1}
    assert len({r.shard for r in rows}) > 10
    bins = defaultdict(list)
    for r in rows:
        bins[r.shard, r.bin].append((r.offset, r.n_tokens, r.bin_tokens))
    for held in bins.values():
        assert sum(n for _, n, _ in held) == held[0][2] and sorted(o for o, _, _ in held) == [100 * k for k in range(len(held))]


def test_ngram_join(docs, none, rows):
    def shingles(t):
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        return {tuple(w[i : i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} if w else set()

    sets = {r[0]: shingles(r[1]) for r in rows}
    root = {i: i for i in sets}
    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                low, high = sorted((root[a], root[b]))
                root = {k: low if v == high else v for k, v in root.items()}
    for tile, most in ((ngram_join.TILE_MEMBERS, ngram_join.RUN), (40, ngram_join.RUN), (40, 2)):
        got = ngram_join.joined(docs, tile_members=tile, most=most).collect()
        assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted((r[0], len(sets[r[0]]), root[r[0]]) for r in rows)
    assert ngram_join.joined(none).count() == 0


@pytest.mark.parametrize("hot", [1000, 1])
def test_repeat_removal(docs, none, rows, hot):
    texts = [(r[0], (r[1] or "").encode()) for r in rows]

    def inside(length):
        counts = Counter(t[i : i + length] for _, t in texts for i in range(len(t) - length + 1))
        return [{j for k in range(len(t) - length + 1) if counts[t[k : k + length]] > 1 for j in range(k, k + length)} for _, t in texts]

    want = []
    for (i, t), gone, near in zip(texts, inside(400), inside(300)):
        words, run = 0, []
        for m in [*re.finditer(rb"[^\x20\x09-\x0D]+", t), None]:
            if m and set(range(m.start(), m.end())) <= near and (not run or set(range(run[0].start(), m.end())) <= near):
                run.append(m)
                continue
            words += len(run) if len(run) >= 50 else 0
            run = [m] if m and set(range(m.start(), m.end())) <= near else []
        want.append((i, len(t), len(gone), sum(k - 1 not in gone for k in gone), hashlib.sha256(bytes(b for k, b in enumerate(t) if k not in gone)).hexdigest(), words))
    assert sorted(map(tuple, repeat_removal.without_repeats(docs, hot_windows=hot).collect())) == sorted(want)
    assert any(x[2] for x in want) and any(x[5] and not x[2] for x in want) and repeat_removal.without_repeats(none).count() == 0


def test_rowwise_operators(spark, docs, none, rows):
    spans = {r.doc_id: r for r in secrets.scanned(docs).collect()}
    assert len(spans) == len({r[0] for r in rows}) and any(r.n_assign for r in spans.values())
    assert all(spans[r[0]].spans == secrets.written(next(secrets.detector().texts([(r[1] or "").encode()]))) for r in rows)
    labels = spark.createDataFrame([(r[0], r[0] % 2) for r in rows if r[1]] + [(10**9, 1), (3, None)], "doc_id long, quality int")
    scores = quality_classifier.scored(docs, quality_classifier.trained(*quality_classifier.sample(docs, labels))).collect()
    assert len(scores) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in scores)
    unlabelled = labels.where("quality IS NULL")
    for frame, known in ((none, labels), (none, unlabelled), (docs, unlabelled)):
        even = quality_classifier.scored(frame, quality_classifier.trained(*quality_classifier.sample(frame, known))).collect()
        assert len(even) == (0 if frame is none else len(rows)) and all(r.score == 0.5 for r in even)
    assert len(quality_classifier.sample(docs, labels, most=0)[0]) <= 3  # empty texts only
    found = {r.doc_id: r for r in language_id.identified(docs, language_id.trained(*language_id.sample(docs))).collect()}
    assert all((found[r[0]].lang_pred == "und") == (not re.search(r"[^\W\d_]", r[1] or "")) for r in rows)
    counts = lm_scoring.words(docs)
    vocabulary = lm_scoring.vocabulary(counts)
    lm = {r.doc_id: r for r in lm_scoring.scored(docs, lm_scoring.trained(docs, vocabulary), vocabulary, counts).collect()}
    assert all(lm[r[0]].n_words == len(WORD.findall(r[1] or "")) and (lm[r[0]].mean_log_prob is None) == (lm[r[0]].n_words == 0) for r in rows)
    packed = packing.packed_documents(docs, shard_tokens=3000).collect()
    tokens = Counter()
    for r in packed:
        tokens[r.doc_id] += r.n_tokens
        assert r.bin_tokens <= r.capacity and r.n_tokens <= 4096
    want = Counter()
    for r in rows:
        want[r[0]] += len(WORD.findall(r[1] or ""))
    assert tokens == +want
    unsaid = lm_scoring.words(none)
    empty = lm_scoring.vocabulary(unsaid)
    assert [x.count() for x in (secrets.scanned(none), packing.packed_documents(none), lm_scoring.scored(none, lm_scoring.trained(none, empty), empty, unsaid), language_id.identified(none, language_id.trained(*language_id.sample(none))))] == [0] * 4


def test_language_model_is_the_same_for_any_layout(docs, monkeypatch):
    def scores(frame, shard_docs):
        counts = lm_scoring.words(frame)
        vocabulary = lm_scoring.vocabulary(counts)
        network = lm_scoring.trained(frame, vocabulary, shard_docs)
        found = lm_scoring.scored(frame, network, vocabulary, counts).collect()
        return network, vocabulary, sorted((r.doc_id, r.n_words, round(r.log_prob, 6), r.n_unseen) for r in found)

    network, vocabulary, one = scores(docs.repartition(1), 10)
    assert one == scores(docs.repartition(8), 10)[2] != scores(docs.repartition(8), 1000)[2]
    counts = Counter(w.lower() for r in docs.select("text").collect() for w in WORD.findall(r.text or ""))
    for r in docs.where("text IS NOT NULL AND length(text) < 3000").collect():  # word by word, without blocks or chunks
        words, total = [w.lower() for w in WORD.findall(r.text)], 0.0
        ids = [int(lm_scoring.word_buckets(w.encode())[0]) for w in words]
        mass = Counter()
        for bucket, c in enumerate(vocabulary.classes):
            mass[int(c)] += math.exp(vocabulary.share[bucket] - vocabulary.single[bucket])
        for k, bucket in enumerate(ids):
            around = [int(vocabulary.neighbours[ids[j]]) if 0 <= j < len(ids) else lm_scoring.NEIGHBOURS - 1 for j in (k - 2, k - 1, k + 1, k + 2)]
            hidden = [math.tanh(sum(float(network.places[p][a][h]) for p, a in enumerate(around)) + float(network.hidden[h])) for h in range(lm_scoring.WIDTH)]
            logits = [sum(x * float(network.out[h][c]) for h, x in enumerate(hidden)) + float(network.bias[c]) for c in range(lm_scoring.CLASSES)]
            mine = int(vocabulary.classes[bucket])
            total += logits[mine] - math.log(sum(map(math.exp, logits))) + math.log(max(counts[words[k]] - words.count(words[k]), lm_scoring.UNSEEN)) - math.log(mass[mine])
        got = [x for x in one if x[0] == r.doc_id][0]
        assert got[1] == len(words) and got[2] == pytest.approx(total, rel=1e-4, abs=1e-3) and got[3] == sum(counts[w] == words.count(w) for w in words)
        if r.doc_id > 8:
            break


def test_repeated_rows_leave_one(spark):
    words = " ".join(f"w{i}" for i in range(80))
    rows = [(i, t, n) for i, t in ((1, words), (2, words + " x"), (3, "quite another text"), (3, "and a third one")) for n in (5, 5, 6)] + [(None, words, 1), (None, None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, every int").repartition(4)
    assert sorted(map(str, ngram_join.representatives(docs).select("doc_id", "text").collect())) == sorted(map(str, ngram_join.representatives(docs.repartition(2)).select("doc_id", "text").collect()))
    assert sorted(r.doc_id or 0 for r in ngram_join.representatives(docs).collect()) == [0, 0, 1, 3, 3]
    kept = exact_dedup.kept_documents(docs).collect()
    assert sorted(r.doc_id or 0 for r in kept) == [0, 1, 2, 3, 3] and sorted(map(str, kept)) == sorted(map(str, exact_dedup.kept_documents(docs.repartition(1)).collect()))


def test_language_model_counts_words_apart_that_share_a_bucket(spark, monkeypatch):
    seen = {}
    for i in range(5000):
        common, rare = seen.setdefault(int(lm_scoring.word_buckets(f"w{i}".encode())[0]), f"w{i}"), f"w{i}"
        if common != rare:
            break
    assert common != rare
    texts = [common, rare, (common + " ") * 49, None, "", common]
    docs = spark.createDataFrame([(i if i else None, t) for i, t in enumerate(texts, 0)], "doc_id long, text string").repartition(3)
    counts = lm_scoring.words(docs)
    vocabulary = lm_scoring.vocabulary(counts)
    network = lm_scoring.trained(docs, vocabulary)
    for most in (lm_scoring.COMMON, 1, 0):  # with the counts at hand, and joined
        monkeypatch.setattr(lm_scoring, "COMMON", most)
        got = {r.doc_id: r for r in lm_scoring.scored(docs, network, vocabulary, counts).collect()}
        assert {k: r.n_words for k, r in got.items()} == {None: 1, 1: 1, 2: 49, 3: 0, 4: 0, 5: 1}
        assert got[5].log_prob - got[1].log_prob == pytest.approx(math.log(50 / lm_scoring.UNSEEN)) and got[None].log_prob == got[5].log_prob
        assert {k: r.n_unseen for k, r in got.items()} == {None: 0, 1: 1, 2: 0, 3: 0, 4: 0, 5: 0}
        assert (got[3].log_prob, got[3].mean_log_prob) == (0, None)


def test_near_stage_takes_five_words_and_four_fifths(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    words = [f"w{i}" for i in range(50)]
    changed = [*words[:25], "other", *words[26:]]  # 41 of 51 shingles of five words, 43 of 51 of four
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(changed)), (3, "something else entirely is said here")], "doc_id long, text string")
    assert sorted(r.doc_id for r in pipeline.near(spark, docs, "").collect()) == [1, 3]


def passes_quality(text):
    words = WORD.findall(text or "")
    chars = sum(map(len, words))
    times = Counter(zip(words, words[1:], words[2:]))
    inside = {k for j, x in enumerate(zip(words, words[1:], words[2:])) if times[x] > 1 for k in (j, j + 1, j + 2)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    symbols, capitals, digits = (len(re.findall(p, text or "")) for p in (r"[#*$%&|<>]", r"[A-ZÀ-ÖØ-Þ]", "[0-9]"))
    wrong = [len(words) < 50, 100 * len(inside) > 50 * len(words), 100 * symbols > 8 * chars, 100 * (len(lines) - len(set(lines))) > 40 * len(lines)]
    return not any([*wrong, 100 * capitals > 50 * chars, 100 * digits > 40 * chars, chars > 25 * len(words), 2 * chars < 3 * len(words)])


def near_roots(texts, width, percent):
    def shingles(t):
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()

    sets = {i: shingles(t) for i, t in texts.items()}
    root = {i: i for i in sets}
    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                low, high = sorted((root[a], root[b]))
                root = {k: low if v == high else v for k, v in root.items()}
    return root


def mixed_times(docs):
    """doc_id to the number of times that the mix takes it; docs: doc_id, text, source."""
    sizes, total = defaultdict(int), 0
    for _, t, source in docs:
        sizes[source] += len(WORD.findall(t or ""))
        total += len(WORD.findall(t or ""))
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    target, free = {}, set(names)
    while True:  # shares of what is left; whoever is above the cap is held there
        left = 1.5 * total - sum(target.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        above = {s for s in free if share[s] > 2 * sizes[s]}
        if not above:
            target |= share
            break
        target |= {s: 2.0 * sizes[s] for s in above}
        free -= above
        if not free:
            break
    times = {}
    for s in names:
        epochs = min(2, int(target[s] // sizes[s])) if sizes[s] else 0
        budget, start = target[s] - epochs * sizes[s], 0

        def key(d):
            draw = (int(hashlib.md5(str(d[0]).encode()).hexdigest()[:13], 16) + 0.5) / 2**52
            symbols = len(re.findall(r"[#*$%&|<>]", d[1] or ""))
            return -math.log(draw) / max(0.1, 1 - 10 * symbols / max(len(d[1] or ""), 1)), d[0]

        for d in sorted((d for d in docs if d[2] == s), key=key):
            n = len(WORD.findall(d[1] or ""))
            times[d[0]] = min(2, epochs + (start < budget and start + n / 2 <= budget))
            start += n
    return times


def test_pipeline_against_brute_force(spark, rows, tmp_path):
    pipeline = pytest.importorskip("corpus_pipeline")
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([r[:5] for r in rows], schema).write.parquet(f"{tmp_path}/documents.parquet")
    good = {r[0]: r for r in rows if passes_quality(r[1])}
    first = {}
    for i, r in sorted(good.items()):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or ""), i)
    unlike = {i: good[i][1] for i in first.values()}
    root = near_roots(unlike, 5, 80)
    left = sorted(i for i in unlike if root[i] == i)
    assert len(good) < len({r[0] for r in rows}) and len(unlike) < len(good) and len(left) < len(unlike)
    times = mixed_times([(i, good[i][1], good[i][3]) for i in left])
    want = Counter()
    for i, n in times.items():
        size = len(WORD.findall(good[i][1]))
        for k in range(-(-size // 4096)):
            want[i, k, min(4096, size - 4096 * k)] += n
    now, columns, ids = spark.read.parquet(f"{tmp_path}/documents.parquet"), schema.replace(" long", "").replace(" string", "").split(", "), []
    for _, stage in pipeline.STAGES[:-1]:
        out = stage(spark, now, str(tmp_path))
        assert out.columns == columns
        now = spark.createDataFrame(out.collect(), now.schema)
        ids.append(Counter(r.doc_id for r in now.collect()))
    assert set(ids[0]) == set(good) and set(ids[1]) == set(unlike) and set(ids[2]) == set(left) and ids[3] == +Counter(times)
    got = pipeline.run(spark, str(tmp_path)).collect()
    assert Counter((r.doc_id, r.piece, r.n_tokens) for r in got) == +want
    bins = defaultdict(list)
    for r in got:
        bins[r.shard, r.bin].append(r)
    for held in bins.values():
        ends = sorted((r.offset, r.n_tokens) for r in held)
        assert ends[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(ends, ends[1:]))
        assert sum(n for _, n in ends) == held[0].bin_tokens and held[0].capacity == min(c for c in packing.LENGTHS if c >= held[0].bin_tokens)


def test_scoring_has_the_driver_collect_its_garbage(spark, tmp_path):
    """Else shuffles and broadcasts of its finished jobs stay in the driver until it happens to."""
    spark.createDataFrame([(i, f"a b c {i}") for i in range(8)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")

    def collections() -> int:
        beans = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
        return sum(b.getCollectionCount() for b in beans if "Old" in b.getName() or "MarkSweep" in b.getName())

    before = collections()
    assert QUERIES["op8_lm_scoring"](spark, str(tmp_path)).count() == 8
    assert collections() >= before + 4


def test_few_links_make_few_files(spark):
    """Executors start processes for each file that they write, which a look at their memory may count with all of theirs."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        made = len(shared._made)
        links = spark.createDataFrame([(i + 1, i) for i in range(0, 60) if i % 20 != 19], "a long, b long").coalesce(1)
        found = {r["node"]: r["component"] for r in components.components(links).collect()}
        assert found == {i: i - i % 20 for i in range(60)}
        assert all(len(spark.read.parquet(path).inputFiles()) < 5 for path in shared._made[made:])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
