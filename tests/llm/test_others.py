"""op3, op6, op10 and the pipeline."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import fingerprints as fp
from tidemark.llm import decontaminate as dc
from tidemark.llm.decontaminate import find_contamination
from tidemark.llm.sharding import op10

SF = "/root/testdata/sf0.001"


def test_edited_texts(spark, make):
    docs = [(i * 3 - 40, "héé wörld " * i + str(i)) for i in range(50)] + [(1000, None), (1001, "")]
    for rows in (docs, docs[:1], docs[:2]):
        known = sorted(rows, key=lambda d: -d[0])
        want = {}
        for i, (d, t) in enumerate(known):
            t, nxt = t or "", known[(i + 1) % len(known)][1] or ""
            n = len(t)
            want[d] = (n, hashlib.sha256((t[:n - n // 2] + nxt[:n // 2]).encode()).hexdigest())
        assert {x.doc_id: (x.n_chars, x.edited_sha256) for x in fp.op3(spark, make(rows)).collect()} == want
    assert fp.op3(spark, make(docs + [(None, "abc"), (None, "abcd" * 30), (5, "dup"), (5, "dup")])).count() == len(docs) + 4
    assert fp.op3(spark, make([])).collect() == []


def test_likeness(spark, small):
    got = fp.op3(spark, small).toPandas()
    assert abs(got.near_edited.mean() - 0.5) < 0.1 and got.near_next.mean() < 0.05
    text = small.first().text * 3
    a, b = fp.sketch(np.frombuffer(text.encode(), np.uint8)), fp.sketch(np.frombuffer(text.encode(), np.uint8))
    assert fp.likeness(a, b) == 1 and fp.to_text(a) == fp.to_text(b)
    empty = fp.sketch(np.zeros(0, np.uint8))
    assert fp.likeness(empty, empty) == 1 and fp.likeness(empty, a) == 0


def test_likeness_follows_the_length():
    rng = np.random.default_rng(3)

    def alike(a, b):
        return fp.likeness(fp.sketch(a), fp.sketch(b))

    for size in (2_000, 100_000, 1_000_000):
        text = rng.integers(32, 127, size).astype(np.uint8)
        header = rng.integers(32, 127, 100).astype(np.uint8)
        parts = [x for k in range(0, size, 5_000) for x in (header, text[k:k + 5_000])]
        assert alike(text, np.concatenate(parts)) > 0.93  # a header every 5 KB
        moved = np.concatenate((text[size // 3:], text[:size // 3]))
        assert alike(text, moved) > 0.95
    one, other = (rng.integers(32, 127, 100_000).astype(np.uint8) for _ in range(2))
    assert alike(one, other) == 0
    other[40_000:50_000] = one[7_000:17_000]  # a tenth in common, elsewhere
    assert 0.06 < alike(one, other) < 0.14
    again = np.tile(one[:500], 400)  # most syncmers are copies
    assert alike(again, one[:500]) > 0.9 and len(fp.sketch(again)[0]) >= fp.ANCHORS


def plain_anchors(data: bytes) -> dict[int, int]:
    """Hash and first place of each anchor, one k-mer after the other."""
    def h(b):
        return int(fp.mix(np.frombuffer(b, np.uint64))[0])

    found, wide = {}, (1 << 64) - 1
    at = [h(data[k:k + fp.S]) for k in range(len(data) - fp.S + 1)]
    for k in range(len(data) - fp.K + 1):
        inner = at[k:k + fp.K - fp.S + 1]
        if min(inner) in (inner[0], inner[-1]):
            z = (inner[0] * 0x9E3779B97F4A7C15 + inner[-1]) & wide
            found.setdefault(h(z.to_bytes(8, "little")) >> 24, k)
    least = sorted(found)
    return {x: found[x] for k, x in enumerate(least) if k < fp.ANCHORS or x < fp.BOUND}


def plain_likeness(a: dict[int, int], b: dict[int, int]) -> float:
    if not a and not b:
        return 1.0
    least = min(max(fp.BOUND, max(z) + 1) if len(z) >= fp.ANCHORS else 1 << 40 for z in (a, b))
    a, b = ({x: p for x, p in z.items() if x < least} for z in (a, b))
    shifts = [p - b[x] for x, p in sorted(a.items(), key=lambda z: z[1]) if x in b]
    n = sum(len(shifts) < 3 or any(abs(s - shifts[m]) <= fp.SLACK for m in (k - 1, k + 1) if 0 <= m < len(shifts))
            for k, s in enumerate(shifts))
    return round(2 * n / (len(a) + len(b)), 6)


def test_fingerprints_equal_brute_force(spark, make, small):
    docs = [(x.doc_id, x.text) for x in small.collect() if x.text and 16 <= len(x.text.encode()) < 6000][:25]
    docs += [(90_000 + k, docs[k][1][len(docs[k][1]) // 3:] + docs[k][1]) for k in range(5)]
    known = sorted(docs, reverse=True)
    anchors = {t: plain_anchors(t.encode()) for _, t in known}
    want = []
    for i, (d, t) in enumerate(known):
        nxt, n = known[(i + 1) % len(known)][1], len(t)
        edited = plain_anchors((t[:n - n // 2] + nxt[:n // 2]).encode())
        text = [" ".join(f"{x:010x}@{p:x}" for x, p in sorted(z.items(), key=lambda z: z[1])) for z in (anchors[t], edited)]
        want.append((d, *text, plain_likeness(anchors[t], edited), plain_likeness(anchors[t], anchors[nxt])))
    got = fp.op3(spark, make(docs)).select("doc_id", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
    assert sorted(map(tuple, got.collect()), reverse=True) == want


def test_fingerprints_of_a_very_long_text(spark, make):
    words = np.random.default_rng(5).integers(0, 50_000, 300_000)
    text = " ".join(map(str, words.tolist()))
    docs = [(3, text), (2, "short one"), (1, text + " and more")]
    got = {x.doc_id: x for x in fp.op3(spark, make(docs)).collect()}
    assert got[3].n_chars == len(text) and got[2].near_next == 0
    assert got[3].fingerprint.count("@") > len(text) / 100
    assert set(got[3].fingerprint.split()) <= set(got[1].fingerprint.split())
    # the edited text is the first half twice: half of the distinct anchors, so Dice is 2 * 0.5 / 1.5
    assert abs(got[1].near_edited - 2 / 3) < 0.02


def test_rows_without_an_id_are_spread(spark, make):
    rows = make([(None, f"text {k} " * 20) for k in range(300)] + [(1, "a"), (2, "b")])
    rows = rows.unionByName(rows)
    parts = {x.part for x in fp.to_ranges(rows).filter("doc_id IS NULL").select("part").collect()}
    assert all(p < 0 for p in parts)
    assert fp.op3(spark, rows).filter("doc_id IS NULL AND near_next = 0").count() == 600


def test_syncmers_do_not_depend_on_the_context():
    rng = np.random.default_rng(1)
    passage = rng.integers(97, 123, 500).astype(np.uint8)
    h, at = fp.syncmers(passage)
    other = np.concatenate((rng.integers(97, 123, 77).astype(np.uint8), passage, rng.integers(97, 123, 31).astype(np.uint8)))
    h2, at2 = fp.syncmers(other)
    inside = (at2 >= 77) & (at2 + fp.K <= 577)
    assert (h2[inside] == h).all() and (at2[inside] - 77 == at).all()
    assert np.diff(at).max() <= fp.K - fp.S + 1


def test_templates_find_changed_questions(spark, make):
    question = ("A train leaves Paris at 3 pm and travels 120 km before it meets a cart that goes 3 miles further "
                "along the road")
    docs = [(1, "x y " + question + " z"), (2, question.replace("Paris", "Rome").replace("3", "7").replace("120", "1,450.5")),
            (3, question.replace("3 miles", "9 miles")), (4, None), (5, ""), (6, "unrelated words only"), (None, question),
            (7, question[:40]), (1, question), (8, question.upper())]
    items = spark.createDataFrame([(10, question), (11, None), (12, ""), (13, "unrelated words only"), (None, question)],
                                  "item_id long, text string")
    got = sorted((str(x.doc_id), x.item_id, x.n_matched, x.n_item, x.verbatim)
                 for x in find_contamination(make(docs), items).collect())
    # in capitals alone a name is a word like others: the run begins after it
    assert [x for x in got if x[0] != "8"] == [
        ("1", 10, 24, 24, True), ("1", 10, 24, 24, True), ("2", 10, 24, 24, False), ("3", 10, 18, 24, True),
        ("None", 10, 24, 24, True)]
    assert all(10 <= x[2] < 24 for x in got if x[0] == "8")
    assert find_contamination(make([]), items).collect() == []
    assert find_contamination(make(docs), items.limit(0)).collect() == []


def test_contamination_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    words = lambda t: re.findall(r"\w+", (t or "").lower())
    grams = {tuple(w[k:k + 10]) for w in (words(x.text) for x in bench.collect()) for k in range(len(w) - 9)}
    want = {x.doc_id for x in docs.collect() for w in [words(x.text)] if any(tuple(w[k:k + 10]) in grams for k in range(len(w) - 9))}
    assert {x.doc_id for x in find_contamination(docs, bench).collect()} == want


def check_shards(spark, df, rows):
    got = op10(spark, df).collect()
    assert Counter((x.doc_id, x.size, x.text_crc32) for x in got) == Counter(
        (d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in rows)
    sizes = Counter(x.shard for x in got)
    counts = [sizes.get(s, 0) for s in range(40)]
    assert sum(counts) == len(rows) and max(counts) - min(counts) <= 1
    for s in range(40):
        assert sorted(x.slot for x in got if x.shard == s) == list(range(counts[s]))
    assert {x.law for x in got} <= {"rows"} and {x.grown_shard for x in got} <= {None}
    return got


def test_shards(spark, make, small):
    rows = [tuple(x) for x in small.collect()]
    got = {x.doc_id: x.shard for x in check_shards(spark, small, rows)}
    groups = {}
    for d, t in rows:
        groups.setdefault(t, set()).add(got[d])
    together = [len(v) == 1 for t, v in groups.items() if sum(t == u for _, u in rows) > 1]
    assert sum(together) >= 0.9 * len(together)
    hot = [(i, "x" if i % 3 else str(i)) for i in range(900)] + [(None, None), (5, ""), (5, "")]
    check_shards(spark, make(hot), hot)
    check_shards(spark, make(hot[:7]), hot[:7])
    assert op10(spark, make([])).collect() == []


def test_shards_do_not_depend_on_the_layout(spark, make):
    rows = [(k, f"copy {k % 7}" if k % 3 else str(k)) for k in range(400)] + [(k, "hot") for k in range(400, 640)]
    rows += [(None, "hot"), (None, None), (5, ""), (5, ""), (6, "x"), (6, "y")]
    docs = make(rows)
    got = [sorted(map(tuple, op10(spark, df).collect()), key=str) for df in
           (docs, docs.repartition(5, "text"), docs.coalesce(1).orderBy(F.desc("doc_id")))]
    assert got[0] == got[1] == got[2] and len(got[0]) == len(rows)


def test_pipeline_stages(spark):
    import corpus_pipeline as cp

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(90001, None, "en", "s", 0), (90002, "", "en", "s", 0), (90003, "12 34", None, "s", 5)], docs.schema)
    docs = docs.unionByName(extra)
    columns, ids = docs.columns, {x.doc_id for x in docs.collect()}
    for k, (name, stage) in enumerate(cp.STAGES):
        docs = stage(spark, docs, SF)
        if k < len(cp.STAGES) - 1:
            assert docs.columns == columns
            docs = cp.staged(docs, name)
            now = {x.doc_id for x in docs.select("doc_id").collect()}
            assert now <= ids and not now & {90001, 90002, 90003}
            ids = now
    last = docs.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert last.filter("n > 1024 OR n <> end").count() == 0
    assert {x.doc_id for x in docs.select("doc_id").distinct().collect()} == ids


def test_stages_of_an_empty_table(spark):
    import corpus_pipeline as cp

    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for k, (name, stage) in enumerate(cp.STAGES):
        out = stage(spark, docs, SF)
        assert out.collect() == [] and (k == len(cp.STAGES) - 1 or out.columns == docs.columns), name


def test_clean_documents_go_through(spark, make):
    import corpus_pipeline as cp

    rows = spark.read.parquet(f"{SF}/documents.parquet").filter("lang = 'en' AND length(text) > 300").limit(30)
    unique = rows.dropDuplicates(["text"])
    kept = {x.doc_id for x in cp.identify_language(spark, unique, SF).collect()}
    assert kept == {x.doc_id for x in unique.collect()}


def test_pipeline_keeps_one_of_repeated_rows(spark, tmp_path):
    import corpus_pipeline as cp

    rng = np.random.default_rng(5)
    text = lambda: " ".join("".join(chr(97 + c) for c in rng.integers(0, 26, 6)) for _ in range(60))
    a, b, c, d, e, item = (text() for _ in range(6))
    rows = [(1, a), (1, a), (1, a), (2, b), (3, b), (3, c), (4, d), (4, e), (5, e), (6, d), (7, item), (7, text())]
    other = rows[-1][1]
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], schema).repartition(3)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in cp.STAGES[:-1]:
        docs = cp.staged(stage(spark, docs, str(tmp_path)), name)
    assert sorted((x.doc_id, x.text) for x in docs.collect()) == sorted(
        [(1, a), (2, b), (3, c), (4, d), (4, e), (7, other)])
    assert [x.doc_id for x in cp.STAGES[-1][1](spark, docs, str(tmp_path)).select("doc_id").distinct()
            .orderBy("doc_id").collect()] == [1, 2, 3, 4, 7]


def test_verbatim_copies_of_any_words(spark, make):
    items = {1: "12 apples, 5 pears, 7 plums, 8 figs, 4 nuts, 3 kiwis, 9 limes",
             2: "1,2,3,4,5,6,7,8,9,10,11", 3: "Alice Bob Carol Dave Erin Frank Grace Heidi Ivan Judy Mallory",
             4: "小明有苹果和梨一共多少个", 5: "ประเทศไทยมีกี่จังหวัด", 6: "how many of these five are 3 7 11 13 17 19 23 29",
             7: "東京は日本の首都です", 8: "7 + 5 * 3 - 2 / 9", 9: "0 " * 300}
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    docs = [(i, "some text before it. " + t + " and after it") for i, t in items.items()]
    docs += [(20, "前面" + items[4] + "后面"), (21, "小明有苹果"), (22, "9 apples, 5 pears, 7 plums"), (23, "0 " * 2000)]
    got = find_contamination(make(docs), bench).collect()
    assert sorted((x.doc_id, x.item_id) for x in got) == [(i, i) for i in range(1, 10)] + [(20, 4), (23, 9)]
    assert all(x.verbatim and x.n_matched <= x.n_item for x in got)
    assert all(x.n_matched == x.n_item for x in got if x.item_id not in (3,))


def test_short_items_are_found_whole(spark, make):
    items = {1: "Name the largest ocean.", 2: "What is seven cubed?", 3: "2 + 2 = 4", 4: "Yes."}
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    docs = [(i, f"Question {i + 4}: {t} (answer below)") for i, t in items.items()] + [(9, "the largest ocean of all"), (10, "what is seven")]
    got = find_contamination(make(docs), bench).collect()
    assert sorted((x.doc_id, x.item_id) for x in got) == [(1, 1), (2, 2)]  # the others have fewer than four words


def test_longest_shared_run_of_words():
    rng = np.random.default_rng(8)
    for _ in range(300):
        a, b = (rng.integers(0, 3, rng.integers(1, 30)).astype(np.uint64) for _ in range(2))
        runs = {}
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
                    n += 1
                runs[n, -i, -j] = 1
        n, i, j = max(runs)
        if n:
            assert dc._shared(a, b, 1) == (n, -i, -j)


def test_longest_consistent_run():
    rng = np.random.default_rng(9)
    none = np.zeros(0)
    for _ in range(2000):
        n = int(rng.integers(1, 20))
        kind = rng.integers(0, 2, n)
        a, b = rng.integers(0, 4, n), rng.integers(0, 4, n)
        b = np.where((kind == 0) | (rng.random(n) < 0.6), a, b)
        item, doc = (dc.Templates(none, x, kind, none, none, none, none) for x in (a, b))
        want = (0, 0, True)
        for i in range(n):
            for j in range(i + 1, n + 1):
                pairs = {(x, y) for x, y, k in zip(a[i:j].tolist(), b[i:j].tolist(), kind[i:j]) if k}
                if len({x for x, _ in pairs}) == len(pairs) == len({y for _, y in pairs}) and j - i > want[0]:
                    want = (j - i, i, all(x == y for x, y in pairs))
        assert dc._longest(doc, 0, item, 0, n) == want


def test_changed_question_with_one_number_twice(spark, make):
    words = "the farmer keeps 6 sheep beside red barns and 6 goats behind tall hedges near our old mill".split()
    assert len(words) == 18 and words[3] == words[9] == "6"
    words[3], words[9] = "4", "8"
    items = spark.createDataFrame([(1, " ".join(words).replace("4", "6").replace("8", "6"))], "item_id long, text string")
    got = find_contamination(make([(1, " ".join(words))]), items).collect()
    assert [(x.n_matched, x.start, x.verbatim) for x in got] == [(14, 4, False)]


def test_groups_that_fit_stay_whole(spark, make):
    sizes = [40, 39, 38, 36, 30, 26, 22, 20, 12, 9, 7, 5, 3, 2]  # of 41 or 40 seats a shard
    texts = [f"group {n}" for n in sizes for _ in range(n)] + ["hot"] * 540
    texts += [f"alone {k}" for k in range(1610 - len(texts))]
    rows = list(enumerate(texts))
    shards = {}
    for x in check_shards(spark, make(rows), rows):
        shards.setdefault(texts[x.doc_id], set()).add(x.shard)
    assert all(len(shards[f"group {n}"]) == 1 for n in sizes)
    assert len(shards["hot"]) == 14


def test_all_seats_taken_by_groups(spark, make):
    rows = [(i, f"pair {i // 5}") for i in range(400)]  # 80 groups of 5 in 40 shards of 10
    assert len({(x.shard, dict(rows)[x.doc_id]) for x in check_shards(spark, make(rows), rows)}) == 80
    rows = [(i, f"six {i // 6}") for i in range(396)] + [(i, str(i)) for i in range(396, 400)]
    placed = {(x.shard, dict(rows)[x.doc_id]) for x in check_shards(spark, make(rows), rows)}
    per = Counter(t for _, t in placed if t.startswith("six"))
    assert sum(n == 1 for n in per.values()) == 40 and max(per.values()) <= 2
