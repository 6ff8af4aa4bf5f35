"""The corpus operators on odd rows, and against brute force on a small fixture."""

from __future__ import annotations

import hashlib
import json
import random

import pytest
import xxhash
from pyspark.sql import functions as F

from starmart.llm import (
    contamination,
    language,
    licenses,
    mixing,
    multiindex,
    quality,
    simhash,
    superkmers,
    toolcalls,
    toxicity,
)

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, fp string, size int"
VOCABULARY = [a + b for a in ("on", "the", "re", "ti") for b in ("er", "st", "an", "in", "ou")]


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


def _rows() -> list[tuple]:
    shared = prose(1, 70)
    texts = {
        1: prose(2, 120) + " " + shared,
        2: shared + " " + prose(3, 90),
        3: prose(4, 200),
        4: prose(4, 200),
        5: "Ta  b\tc " + prose(4, 199),
        6: "",
        7: None,
        8: " \n ",
        9: "one two",
        10: "be " * 300,
        11: prose(5, 4000),
    }
    rows = [(i, t, "en", f"s{i % 3}", 1, "x", 2) for i, t in texts.items()]
    return [*rows, rows[2], (None, prose(4, 200), None, None, None, None, None), (12, prose(6, 9), "de", None, 0, "", 0)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(_rows(), DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def pairs(df, *columns) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def brute_print(text: str | None) -> int:
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_classes(docs, empty):
    prints = [(r[0], brute_print(r[1])) for r in _rows()]
    member = {p for _, p in prints}
    root = {p: p for p in member}
    for _ in member:
        for a in member:
            for b in member:
                if (a ^ b).bit_count() <= 2:
                    root[a] = root[b] = min(root[a], root[b])
    least = {p: min(i for i, q in prints if i is not None and root[q] == root[p]) for p in member}
    want = sorted(((i, f"{p:016x}", least[p]) for i, p in prints), key=repr)
    found = simhash.near_classes(docs)
    assert pairs(found, "doc_id", "fingerprint", "component_id") == want
    assert simhash.near_classes(empty).count() == 0
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert [r[0] for r in pairs(kept, "doc_id")] == sorted(set(least.values()), key=repr)


@pytest.mark.parametrize("crowd", [2, 64])
def test_simhash_links_in_crowds(spark, monkeypatch, crowd):
    monkeypatch.setattr(simhash, "CROWD", crowd)
    rng = random.Random(7)
    base = rng.getrandbits(63)
    prints = {base ^ (1 << rng.randrange(63)) ^ (1 << rng.randrange(63)) for _ in range(60)}
    prints |= {rng.getrandbits(63) for _ in range(20)}
    want = {(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 2}
    frame = spark.createDataFrame([(p,) for p in prints], "fp bigint")
    assert {tuple(r) for r in simhash.links(frame).collect()} == want


def edited(text: str, places) -> str:
    words = text.split()
    for k in places:
        words[k] = f"edit{k}"
    return " ".join(words)


def grams(text: str | None) -> frozenset[str]:
    words = (text or "").lower().split()
    return frozenset(" ".join(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def test_near_duplicate_stage(spark):
    import corpus_pipeline

    rows = [(i, t) for i, t, *_ in _rows()]
    for k in range(30):
        base, at = prose(100 + k, 300), random.Random(k).sample(range(10, 290), 8)
        rows += [(100 + 10 * k, base)] + [(101 + 10 * k + n, edited(base, at[: 2 * n + k % 3])) for n in range(4)]
    crowd = prose(77, 250)  # more copies than are alike pair by pair
    rows += [(1000 + n, edited(crowd, random.Random(n).sample(range(250), 1 + n % 7))) for n in range(120)]
    sets = [grams(t) for _, t in rows]
    alike = lambda x, y: x == y or 10 * len(x & y) >= 8 * len(x | y)
    first = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if alike(sets[a], sets[b]) and first[a] != first[b]:
                least, most = sorted((first[a], first[b]))
                first = [least if x == most else x for x in first]
    ids = [float("inf") if i is None else i for i, _ in rows]
    want = sorted(min(i for i, f in zip(ids, first, strict=True) if f == c) for c in set(first))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = corpus_pipeline.near_duplicates(spark, frame, "")
    assert kept.columns == frame.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == want
    assert len(want) < len(set(sets)) - 60
    assert corpus_pipeline.near_duplicates(spark, frame.limit(0), "").count() == 0


def test_near_duplicate_stage_goes_by_fingerprints(spark, monkeypatch):
    import corpus_pipeline
    from starmart.llm import nearcopies

    # without bands nothing else brings the copies together
    monkeypatch.setattr(nearcopies, "bands", lambda found: [])
    # most shingles of the first two are one, so operator 7 links them; their sets are apart
    texts = ["go " * 120 + prose(k, 6) for k in (1, 2)] + [prose(3, 60), prose(3, 60).upper(), None, " "]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    linked = {r["doc_id"]: r["component_id"] for r in simhash.near_classes(frame).collect()}
    assert linked == {0: 0, 1: 0, 2: 2, 3: 2, 4: 4, 5: 4}
    near = "no " * 120 + prose(5, 30)  # another last word: of 32 shingles 30 are in both
    more = frame.union(spark.createDataFrame([(9, near), (10, near[: near.rindex(" ")] + " go")], frame.schema))
    kept = corpus_pipeline.near_duplicates(spark, more, "")
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 1, 2, 4, 9]


def test_near_duplicate_stage_compares_all_of_a_fingerprint_class(spark, monkeypatch):
    import corpus_pipeline
    from starmart.llm import nearcopies

    monkeypatch.setattr(nearcopies, "bands", lambda found: [])
    # operator 7 links all of them; only those of one tail are alike
    texts = [f"{'go ' * 120}{prose(40 + k, 30)} {last}" for k in range(4) for last in ("on", "off")]
    # one id for two texts, no id, a row repeated whole
    ids = [0, 1, 1, 3, 4, 4, None, 7]
    rows = list(zip(ids, texts, strict=True))
    frame = spark.createDataFrame([*rows, rows[3]], "doc_id bigint, text string")
    assert {r["component_id"] for r in simhash.near_classes(frame).collect()} == {0}
    kept = [r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, frame, "").collect()]
    assert sorted(kept) == [0, 1, 4, 7]


def brute_strip(rows: list[tuple]) -> list[tuple]:
    first: dict[bytes, int] = {}
    for i, text, *_ in rows:
        words = (text or "").encode().split()
        for k in range(len(words) - 49):
            w = b" ".join(words[k : k + 50])
            if i is not None:
                first[w] = min(first.get(w, i), i)
    out = []
    for i, text, *_ in rows:
        words = (text or "").encode().split()
        keep = [True] * len(words)
        for k in range(len(words) - 49):
            if i is not None and first[b" ".join(words[k : k + 50])] < i:
                keep[k : k + 50] = [False] * 50
        left = b" ".join(w for w, x in zip(words, keep, strict=True) if x)
        out.append((i, len(words), keep.count(False), hashlib.sha256(left).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("crowd", [1, 200])
def test_repeated_passages(docs, empty, monkeypatch, crowd):
    monkeypatch.setattr(superkmers, "CROWD", crowd)
    found = superkmers.strip_repeats(docs)
    want = brute_strip(_rows())
    assert pairs(found, "doc_id", "n_words", "n_removed", "kept_sha256") == want
    assert sum(r[2] for r in want) > 250
    assert superkmers.strip_repeats(empty).count() == 0
    cut = superkmers.cut_repeats(docs)
    assert cut.columns == docs.columns
    left = [(r["doc_id"], hashlib.sha256(" ".join((r["text"] or "").split()).encode()).hexdigest()) for r in cut.collect()]
    assert sorted(left, key=repr) == sorted(((r[0], r[3]) for r in want if r[1] > r[2] or not r[1]), key=repr)
    before = {(r[0], r[1]): r[4] for r in _rows()}
    for r in cut.collect():  # untouched rows keep their count, the others are counted anew
        assert r["n_chars"] == before.get((r["doc_id"], r["text"]), len(r["text"] or ""))
    assert superkmers.cut_repeats(empty).count() == 0


def test_contamination(spark, docs, empty):
    items = [(1, prose(1, 25).upper()), (2, "one--TWO"), (3, ""), (4, None), (10, "one, two!"), (5, "not there")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = {
        (r["doc_id"], r["n_words"]): r for r in contamination.contamination(docs, bench).collect()
    }
    assert found[9, 2]["n_hit"] == 2 and found[9, 2]["n_items"] == 2
    assert found[9, 2]["items_sha256"] == hashlib.sha256(b"10,2").hexdigest()
    assert found[1, 190]["n_hit"] == found[2, 160]["n_hit"] == 25
    assert {k[0] for k, r in found.items() if r["contaminated"]} == {1, 2, 9}
    assert found[7, 0]["items_sha256"] == hashlib.sha256(b"").hexdigest()
    clean = contamination.clean_documents(docs, bench)
    assert clean.columns == docs.columns and clean.count() == len(_rows()) - 3
    assert contamination.contamination(empty, bench).count() == 0
    assert not contamination.contamination(docs, bench.limit(0)).where("contaminated").count()
    near = contamination.proximity_matches(docs, bench.where("item_id = 2"), span=3)
    assert [r["at"] for r in near.collect()] in ([[0]], [[1]])


def test_contamination_of_long_periodic_texts(spark):
    """Windows and positions of one term are not multiplied out; edges of a text are no hit."""
    texts = ["be " * 200_000, "be " * 9, "x " + "be " * 10, "to be " * 50_000, "be " * 10 + "y", "be " * 10 + "y"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    items = [(1, "be " * 10), (2, "to be " * 5), (3, "be to " * 6), (4, "be be x"), (5, "x be")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = {r["doc_id"]: r for r in contamination.contamination(frame, bench).collect()}
    assert [found[i]["n_hit"] for i in range(6)] == [200_000, 0, 11, 100_000, 10, 10]
    assert [found[i]["n_items"] for i in range(6)] == [1, 0, 2, 2, 1, 1]


def test_mix(docs, empty):
    rows, sources, blocks = mixing.mix(docs)
    want = {r["source"]: r["target"] for r in sources.collect()}
    size = {r["source"]: r["source_size"] for r in sources.collect()}
    assert sum(want.values()) == pytest.approx(1.5 * sum(size.values()))
    taken = {r[0]: r[1] for r in blocks.groupBy("source").sum("n_words").collect()}
    for source, target in want.items():
        assert target <= 2 * size[source] + 1e-6
        assert abs(taken.get(source, 0) - target) <= mixing.BLOCK_WORDS
    of = blocks.groupBy("doc_id", "text_key", "twin").sum("n_words").collect()
    most = {(r[0], r[1]): r[3] for r in rows.collect()}
    assert all(r[3] <= 2 * most[r[0], r[1]] for r in of)
    assert rows.count() == len(_rows())
    again = mixing.mix(docs.orderBy("text"))[2]
    assert pairs(again, *blocks.columns) == pairs(blocks, *blocks.columns)
    assert mixing.mix(empty)[2].count() == 0


def test_split_tree_is_exact(spark):
    quotas = spark.createDataFrame([(0, 1000), (1, 7), (2, 333)], "idx int, quota bigint")
    rows = mixing.split_quotas(quotas, 5).collect()
    by_shard = [sum(r["to"] - r["from"] for r in rows if r["shard"] == s) for s in range(5)]
    assert sum(by_shard) == 1340 and max(by_shard) - min(by_shard) <= 2
    for idx, quota in ((0, 1000), (1, 7), (2, 333)):
        spans = sorted((r["from"], r["to"]) for r in rows if r["idx"] == idx)
        assert spans[0][0] == 0 and spans[-1][1] == quota
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))


def test_near_vectors(spark):
    rng = random.Random(3)
    rows = []
    for k in range(120):
        v = [rng.gauss(0, 1) for _ in range(16)]
        rows.append((3 * k, v, k % 3))
        if k % 4 == 0:
            rows.append((3 * k + 1, [x + rng.gauss(0, 0.1) for x in v], k % 3))
        if k % 10 == 0:
            rows.append((3 * k + 2, v, k % 3))
    odd = [(900, None, 1), (901, [0.0] * 16, 1), (902, [float("nan")] * 16, 1), (903, rows[0][1], None)]
    frame = spark.createDataFrame([*rows, *odd, (None, rows[0][1], 0)], "vec_id bigint, embedding array<double>, label int")
    found = {r[0]: (r[1], r[2]) for r in multiindex.near_vectors(frame).collect()}

    def cosine(a, b):
        dot = lambda x, y: sum(p * q for p, q in zip(x, y, strict=True))
        return dot(a, b) / (dot(a, a) * dot(b, b)) ** 0.5

    links = {
        (a[0], b[0])
        for a in rows
        for b in rows
        if a[0] != b[0] and a[2] == b[2] and cosine(a[1], b[1]) >= 0.93
    }
    got = sum(found[r[0]][0] for r in rows)
    assert 0.9 * len(links) <= got <= len(links)
    assert all(found[i] == (0, i) for i in (900, 901, 902, 903)) and found[None] == (0, None)
    assert multiindex.near_vectors(frame.limit(0)).count() == 0


def test_near_vectors_of_other_lengths_and_repeated_ids(spark):
    """Minority lengths are compared exactly, one component too; an id may name several rows."""
    rng = random.Random(8)
    rows = [(k, [rng.gauss(0, 1) for _ in range(16)], k % 2) for k in range(40)]
    for size in (1, 2, 8):
        for k in range(12):
            v = [rng.gauss(0, 1) for _ in range(size)]
            rows.append((1000 * size + 2 * k, v, k % 2))
            rows.append((1000 * size + 2 * k + 1, [2 * x for x in v], k % 2))
    rows += [(3, rows[5][1], 1), (3, [9.0] * 16, 0), (3, [-1.0, 0.5], 0), (50, [], 1)]

    def alike(a, b):
        if a[2] != b[2] or len(a[1]) != len(b[1]) or not a[1]:
            return False
        dot = lambda x, y: sum(p * q for p, q in zip(x, y, strict=True))
        return dot(a[1], b[1]) >= 0.93 * (dot(a[1], a[1]) * dot(b[1], b[1])) ** 0.5

    n = range(len(rows))
    near = {i: [j for j in n if j != i and alike(rows[i], rows[j])] for i in n}
    root = list(n)
    for _ in n:
        root = [min([root[i], *(root[j] for j in near[i])]) for i in n]
    least = {r: min(rows[i][0] for i in n if root[i] == r) for r in root}
    want = [(rows[i][0], len(near[i]), least[root[i]], rows[i][0] == least[root[i]]) for i in n]
    schema = "vec_id bigint, embedding array<double>, label int, rep int, cell string, low int, class int, n int"
    frame = spark.createDataFrame([(*r, 1, "c", 2, 3, 4) for r in rows], schema)
    for some in (frame, frame.where("size(embedding) < 2")):
        have = sorted(tuple(r) for r in multiindex.near_vectors(some).collect())
        ids = {r[0] for r in rows if some is frame or len(r[1]) < 2}
        assert have == sorted(w for i, w in zip(n, want, strict=True) if some is frame or len(rows[i][1]) < 2) and ids


def test_toxicity(spark, docs, empty):
    rows, marks = [], []
    for i in range(400):
        toxic = i % 4 == 0
        group = "muslim" if toxic or i % 50 == 1 else "christian"
        rows.append((i, f"{prose(i, 30)}. {group} {'idiot scum' if toxic else ''}"))
        marks.append((i, int(toxic)))
    texts = spark.createDataFrame([*rows, (None, None), (9999, "hindu " + prose(8, 9))], "doc_id bigint, text string")
    labels = spark.createDataFrame([*marks, (5, None), (None, 1)], "doc_id bigint, toxic int")
    found = {r["doc_id"]: r for r in toxicity.classify(texts, labels).collect()}
    assert all(found[i]["predicted"] == t for i, t in marks)
    fair, free = (toxicity.fit(*_training(texts, labels), fairness=x) for x in (50.0, 0.0))
    gap = lambda w: abs(w["muslim"] - w["christian"])
    assert gap(fair) < 0.2 * gap(free)
    assert toxicity.classify(docs, labels.limit(0)).count() == len(_rows())
    assert toxicity.classify(empty, labels).count() == 0


def _training(texts, labels):
    sample = toxicity.labelled_sample(texts, labels, 1000)
    train = texts.join(sample, texts["doc_id"] == sample["id"]).select("text", "toxic")
    words = ["idiot", "scum", *sorted(toxicity.SWAPS)]
    return *toxicity.training_rows(train, words), words


def test_language(spark, docs, empty):
    german = ["keit", "schung", "ein", "der", "über", "zeit"]
    rows = [(i, " ".join(random.Random(i).choices(german, k=40)), "de") for i in range(0, 80, 2)]
    rows += [(i, prose(i, 40), "en") for i in range(1, 80, 2)]
    mixed = (200, " ".join(german * 4) + " " + prose(9, 60), None)
    odd = [(201, "123 !", "en"), (202, None, "en"), (204, "\u0301\u0302 \u0308", None), (205, "der\0keit \0", None), (203, "привет мир", None), (None, prose(3, 9), None)]
    frame = spark.createDataFrame([*rows, mixed, *odd], "doc_id bigint, text string, lang string")
    found = {r["doc_id"]: r for r in language.identify(frame, language.learn(frame)).collect()}
    assert all(found[i]["lang_pred"] == lang for i, _, lang in rows)
    assert [s["lang"] for s in found[200]["spans"]] == ["de", "en"]
    assert found[200]["spans"][0]["stop"] == 24
    assert found[201]["lang_pred"] == found[202]["lang_pred"] == found[204]["lang_pred"] == "und"
    assert (found[205]["lang_pred"], found[205]["spans"][0]["stop"]) == ("de", 2)
    whole = language.learn(frame).word_scores
    assert [len(x) for x in whole(["a\0\u0301 b\0", "\0", "c"])] == [3, 3, 3]
    assert language.identify(empty, language.learn(empty)).count() == 0


def test_quality(spark, docs, empty):
    rows = [(i, prose(i, 60), 1) for i in range(80)]
    rows += [(i, " ".join(w.upper() + "!!" for w in prose(i, 60).split()), 0) for i in range(80, 100)]
    texts = spark.createDataFrame([(r[0], r[1]) for r in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id bigint, quality int")
    kept = {r["doc_id"] for r in quality.resample(texts, labels).where("kept").collect()}
    assert kept == set(range(80))
    assert quality.resample(docs, labels.limit(0)).where("kept").count() == len(_rows())
    assert quality.resample(empty, labels).count() == 0


@pytest.mark.parametrize("k", [1, 7, 250, 500])
def test_kth_largest(spark, monkeypatch, k):
    monkeypatch.setattr(quality, "FEW", 3)
    values = [random.Random(i).choice([1.0, 2.5, i / 7, -float(i)]) for i in range(500)]
    frame = spark.createDataFrame([(v,) for v in values], "x double")
    assert quality.kth_largest(frame, "x", k) == sorted(values, reverse=True)[k - 1]


def test_licenses(docs, empty, spark):
    mit = licenses.TEMPLATES["MIT"]
    texts = [
        (1, prose(1, 30) + "\n" + mit + "\n" + prose(2, 30)),
        (2, prose(3, 20) + " Released under the\nMIT license! " + prose(4, 10)),
        (3, mit.replace("copies of the Software,", "copies,").replace("sell", "vend")),
    ]
    frame = spark.createDataFrame(texts, "doc_id bigint, text string")
    found = {(r["doc_id"], r["template"]): r for r in licenses.scan(frame).collect()}
    assert set(found) == {(1, "MIT"), (2, "MIT-line"), (3, "MIT")}
    assert found[1, "MIT"]["start_word"] == 30 and found[1, "MIT"]["coverage"] == 1
    assert found[2, "MIT-line"]["start_word"] == 20 and found[2, "MIT-line"]["end_word"] == 25
    assert 0.9 < found[3, "MIT"]["coverage"] < 1
    assert licenses.scan(docs).count() == licenses.scan(empty).count() == 0


def test_tool_calls(spark):
    def call(*calls):
        return json.dumps({"tool_calls": list(calls)})

    def one(i, after=(), **arguments):
        return {"id": i, "name": "ask", "arguments": arguments, "after": list(after)}

    messages = [
        (1, 0, "assistant", call(one("b", ["a"], turn=1, prompt="x"), one("a", turn=0, prompt="y" * 401))),
        (1, 1, "tool", json.dumps({"tool_call_id": "a", "content": "ok"})),
        (1, 2, "tool", json.dumps({"tool_call_id": "zz", "content": "?"})),
        (2, 0, "assistant", call(one("p", ["q"], turn="1"), one("q", ["p"], turn=-1, prompt="", more=1))),
        (3, 0, "user", "hello"),
        (4, 0, "assistant", None),
        (5, 0, "assistant", "no json"),
    ]
    frame = spark.createDataFrame(messages, "conv_id bigint, turn bigint, role string, text string")
    found = {r["conv_id"]: r for r in toolcalls.link_calls(frame, toolcalls.conversation_tools(spark)).collect()}
    assert set(found) == {1, 2}
    first = json.loads(found[1]["canonical"])
    assert [c["id"] for c in first["calls"]] == ["a", "b"] and first["orphans"] == ["zz"]
    assert first["calls"][0]["errors"] == ["length prompt"] and first["calls"][0]["result"] == "ok"
    assert (found[1]["n_linked"], found[1]["n_invalid"], found[2]["n_circular"]) == (1, 1, 2)
    errors = {c["id"]: c["errors"] for c in json.loads(found[2]["canonical"])["calls"]}
    assert errors == {"p": ["missing prompt", "type turn"], "q": ["minimum turn", "unknown more"]}
    assert found[1]["canonical"] == json.dumps(first, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def test_call_ranks_and_calls_without_conversation(spark):
    rng = random.Random(5)
    after = {f"c{i:03d}": [f"c{j:03d}" for j in range(i) if rng.random() < 0.05] for i in range(80)}
    after |= {f"k{i:03d}": [f"k{i - 1:03d}"] for i in range(1, 150)} | {"k000": ["gone"]}
    after |= {"x": ["y", "c001"], "y": ["x"], "z": ["x"], "self": ["self"]}
    want: dict[str, int] = {}
    for _ in after:
        for i, waits in after.items():
            waits = [w for w in waits if w in after]
            if all(w in want for w in waits):
                want[i] = 1 + max((want[w] for w in waits), default=0)
    rows = [(conv, i, waits) for conv in (1, None) for i, waits in after.items()]
    calls = spark.createDataFrame(rows, "conv_id bigint, call_id string, after array<string>")
    found = [tuple(r) for r in toolcalls.ranked(calls).collect()]
    assert sorted(found, key=repr) == sorted(((k, i, want.get(i)) for k in ("c1", "null") for i in after), key=repr)

    one = lambda i: {"id": i, "name": "ask", "arguments": {"turn": 1, "prompt": ""}, "after": []}
    messages = [(None, k, "assistant", json.dumps({"tool_calls": [one(f"n{k}")]})) for k in range(3)]
    messages += [(None, 9, "tool", json.dumps({"tool_call_id": i, "content": "ok"})) for i in ("n1", "lost")]
    frame = spark.createDataFrame(messages, "conv_id bigint, turn bigint, role string, text string")
    linked = toolcalls.link_calls(frame, toolcalls.conversation_tools(spark)).collect()
    counts = sorted((r["n_calls"], r["n_linked"], r["n_orphans"]) for r in linked)
    assert counts == [(0, 0, 1), (1, 0, 0), (1, 0, 0), (1, 1, 0)]


def test_no_message_vanishes(spark):
    rows = [(None, 0, "user", f"q{i}") for i in range(5)] + [(None, 1, "assistant", f"a{i}") for i in range(5)]
    rows += [(1, 0, "user", "first"), (1, 0, "user", "second"), (1, 1, "assistant", "x"), (1, 1, "assistant", "x")]
    rows += [(1, None, "user", "early"), (1, 2, None, "who"), (1, 3, "user", None), (1, 3, "user", None)]
    rows += [(1, 5000, "assistant", "late"), (2, 0, "assistant", "none"), (2, 1, "assistant", "asked"), (3, None, None, None)]
    schema = "conv_id bigint, turn bigint, role string, text string, own int, lone int, above int, place int, block int"
    frame = spark.createDataFrame([(*r, 1, 1, 1, 1, 1) for r in rows], schema)
    tools = toolcalls.conversation_tools(spark)
    found = toolcalls.link_calls(toolcalls.as_messages(frame), tools).collect()
    assert sum(r["n_calls"] + r["n_linked"] + r["n_orphans"] + r["n_repeats"] for r in found) == len(rows)
    alone = sorted((r["n_calls"], r["n_linked"], r["n_orphans"]) for r in found if r["conv_id"] is None)
    assert alone == [(0, 0, 1)] * 5 + [(1, 0, 0)] * 5
    one = next(r for r in found if r["conv_id"] == 1)
    assert (one["n_calls"], one["n_linked"], one["n_repeats"], one["n_orphans"]) == (5, 2, 2, 0)
    calls = json.loads(one["canonical"])["calls"]
    assert [c["arguments"].get("prompt") for c in calls][0] == "early" and calls[0]["errors"] == ["missing turn"]
    assert {c["arguments"].get("prompt") for c in calls} == {"early", "first", "second", "who", None}
    who = next(c for c in calls if c["arguments"].get("prompt") == "who")
    assert who["errors"] == ["unknown tool"] and who["after"] == [max(c["id"] for c in calls if "-0-" in c["id"])]
    assert [c["result"] for c in calls if "result" in c] == ["x", "late"]
    assert next(r for r in found if r["conv_id"] == 2)["n_orphans"] == 2
    again = toolcalls.link_calls(toolcalls.as_messages(frame.repartition(5).orderBy(F.rand(3))), tools)
    assert sorted(map(repr, again.collect())) == sorted(map(repr, found))
    assert toolcalls.link_calls(toolcalls.as_messages(frame.limit(0)), tools).count() == 0


def test_pipeline_stages_keep_columns(spark, docs):
    import corpus_pipeline

    kept = docs
    for _, stage in corpus_pipeline.STAGES[1:3]:
        kept = stage(spark, kept, "/root/testdata/sf0.001")
        assert kept.columns == docs.columns
    assert len(corpus_pipeline.STAGES) == 5


def test_columns_with_clashing_names(spark, docs):
    """Extra columns named like the operators' own come through, and none is mistaken."""
    names = ["n", "key", "row", "cands", "_id", "_key", "_spans", "words", "hits", "text_key"]
    names += ["good", "_good", "toxic", "quality", "id", "w", "minimiser", "rest", "kept", "size2"]
    extra = docs.where("doc_id < 10").select("*", *[F.lit(7).alias(c) for c in names])
    labels = spark.createDataFrame([(1, 1, 0), (10, 0, 1)], "doc_id bigint, quality int, toxic int")
    bench = spark.createDataFrame([(2, "one two")], "item_id bigint, text string")
    kept = {
        "quality": quality.keep_good(extra, labels, 1.0),
        "simhash": simhash.keep_first(extra),
        "superkmers": superkmers.cut_repeats(extra),
        "contamination": contamination.clean_documents(extra, bench),
    }
    for name, rows in kept.items():
        assert rows.columns == extra.columns, name
        assert rows.count() == rows.where("n = 7 AND row = 7 AND hits = 7").count(), name
    assert kept["quality"].count() == extra.count()
    assert kept["contamination"].count() == extra.count() - 1
    for rows in (
        toxicity.classify(extra, labels),
        language.identify(extra, language.learn(extra)),
        superkmers.strip_repeats(extra),
        contamination.contamination(extra, bench),
    ):
        assert rows.count() == extra.count()
    assert mixing.mixed_texts(extra).count() > 0
