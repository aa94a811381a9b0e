"""The operators of lexifacet.llm against plain Python, on small tables with odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from lexifacet.llm import (
    chat,
    decontamination,
    extraction,
    fingerprints,
    fixity,
    hmm,
    mixing,
    queries,
    simhash,
    token_counts,
    toxicity,
)
from lexifacet.llm.components import compact_components, components

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, item_id bigint, hash bigint, node bigint"
WORDS = "the of and to in that river stone cloud light paper winter glass mountain yellow seven".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 40)) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    texts = [prose(rng, rng.choice([1, 2, 4, 30, 90])) for _ in range(60)]
    texts += [None, "", " \n\t", "Éa\x0bB\rc", texts[5], texts[5], texts[6] + " end", prose(rng, 9000)]
    rows = [(i, t, None, [None, "b", "a", "é"][i % 4], None, 1, 2, 3) for i, t in enumerate(texts)]
    return [*rows, rows[7], rows[7], (7, "other text", None, "a", 0, 0, 0, 0), (None, "no id", None, "a", 0, 0, 0, 0), (None, None, None, None, 0, 0, 0, 0)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_fingerprints(docs, rows, none):
    got = fingerprints.fingerprint_edits(docs).collect()
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), (r[1] or "").encode()))
    texts = [r[1] or "" for r in order]

    def shingles(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    want = Counter()
    near = {}
    for i, (row, text) in enumerate(zip(order, texts)):
        m = len(text) // 3
        edited = text[: len(text) - m] + texts[(i + 1) % len(texts)][:m]
        digest = hashlib.sha256(edited.encode()).hexdigest()
        want[row[0], len(text), digest] += 1
        a, b = shingles(text), shingles(edited)
        near[row[0], digest] = len(a & b) / len(a | b) if a | b else 1.0
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == want
    for r in got:
        assert abs(r.near_edited - near[r.doc_id, r.edited_sha256]) < 0.25
    assert fingerprints.fingerprint_edits(none).count() == 0
    few = fingerprints.with_next(docs, rows_per_part=4)
    assert few.where("guest = 0").count() == len(rows)


def test_sketches_merge(spark, docs):
    hashed = docs.where("doc_id is not null").withColumn("h", fingerprints.word_hashes(F.col("text")))
    sketched = hashed.withColumn("sketch", fingerprints.sketch(F.col("h"), 16))
    merged = fingerprints.merge_groups(sketched, ["n_chars"], k=16).collect()
    for m in merged:
        every = [r.sketch for r in sketched.where(F.col("n_chars").eqNullSafe(F.lit(m.n_chars))).collect()]
        assert m.sketch == sorted({h for s in every for h in s})[:16]


def test_mixing(docs, rows, none):
    plan = mixing.mix_plan(docs, block_words=64, shards=5)
    got = mixing.taken(plan).collect()
    assert sorted(map(str, got)) == sorted(map(str, mixing.taken(mixing.mix_plan(docs, block_words=64, shards=5)).collect()))
    assert len(got) == len(rows)
    assert all(0 <= r.taken <= 3 * r.size for r in got)
    by_target = Counter()
    for r in got:
        by_target[r.source_size, r.target] += r.taken
    for (size, target), taken in by_target.items():
        assert taken == math.floor(target) and target <= 3 * size
    assert mixing.taken(mixing.mix_plan(none)).count() == 0
    drawn = mixing.shard_rows(plan).collect()
    assert sum(r.to_word - r.from_word for r in drawn) == sum(r.taken for r in got)
    # Every word of a source's round stands in one place of one block, and every block in one shard.
    spans = sorted((r.key, r.block * 64, r.copy, r.at + r.from_word, r.at + r.to_word, r.shard) for r in drawn)
    shard_of, blocks = {}, Counter()
    for key, block, copy, first, last, shard in spans:
        assert last > first and shard_of.setdefault((key, block), shard) == shard
        blocks[key] += last - first
    quotas = {k: -(-n // 64) for k, n in blocks.items()}
    assert Counter(k for k, _ in shard_of) == quotas
    assert sum(len(r.draws or []) for r in got) == len(drawn)
    dealt = mixing.deal_blocks(plan.docs.sparkSession.createDataFrame([("s", 70000, [20000, 69990, 70000]), ("n", 0, [0, 0, 0])], "key string, quota bigint, ends array<bigint>"))
    order = [r.shard for r in dealt.orderBy("block").collect()]
    assert Counter(order) == {0: 20000, 1: 49990, 2: 10} and order != sorted(order)
    split = mixing.split_quotas([100, 7, 0, 31], 6)
    assert split.sum(axis=0).tolist() == [100, 7, 0, 31]
    assert max(split.sum(axis=1)) - min(split.sum(axis=1)) <= 1


def test_simhash(docs, rows, none):
    def slow(text):
        w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
        if not w:
            return 0
        h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), seed=42) for i in range(max(1, len(w) - 2))]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    prints = [slow(r[1]) for r in rows]
    label = list(range(len(rows)))
    for _ in rows:
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if (a ^ b).bit_count() <= 2:
                    label[i] = label[j] = min(label[i], label[j])
    ids = {}
    for r, g in zip(rows, label):
        ids.setdefault(g, []).append(r[0])
    least = {g: min((x for x in v if x is not None), default=None) for g, v in ids.items()}
    want = Counter((r[0], p - (1 << 64) if p >> 63 else p, least[g]) for r, p, g in zip(rows, prints, label))
    found = simhash.near_duplicates(docs).collect()
    assert Counter((r.doc_id, r.f, r.component_id) for r in found) == want
    kept = simhash.one_of_each_group(docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(least.values())
    assert simhash.near_duplicates(none).count() == 0 and simhash.one_of_each_group(none).count() == 0


def test_links_are_complete(spark):
    rng = random.Random(1)
    base = [rng.getrandbits(64) for _ in range(20)]
    every = {x for b in base for x in [b, *(b ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(30))]}
    signed = {x - (1 << 64) if x >> 63 else x for x in every}
    got = {(r.a, r.b) for r in simhash.links(spark.createDataFrame([(x,) for x in signed], "f bigint")).collect()}
    mask = (1 << 64) - 1
    assert got == {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & mask).bit_count() <= 2}


def test_one_of_each_group_of_hot_rows(spark):
    """A row that is a third of the table, without an id; clashing column names."""
    rng = random.Random(10)
    rows = [(i, prose(rng, 40), i) for i in range(200)] + [(None, "the same text", 1)] * 150 + [(None, None, 2)] * 3
    df = spark.createDataFrame(rows, "doc_id bigint, text string, _llm_n int").withColumnRenamed("_llm_n", "f")
    kept = simhash.one_of_each_group(df)
    assert kept.columns == df.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([*range(200), None, None])


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "a bigint, b bigint")
    roots = {r.node: r.root for r in components(edges).collect()}
    assert roots == {**{i: 0 for i in range(1, 41)}, 101: 100}
    assert {r.node: r.root for r in compact_components(edges).collect()} == roots
    few = {r.node: r.root for r in compact_components(edges.where("a < 6"), 2).collect()}
    assert few == {i: 0 for i in range(1, 7)}
    assert compact_components(edges.limit(0)).count() == 0


def test_hmm(docs, rows, none):
    got = hmm.score_documents(docs, rounds=2).collect()
    assert len(got) == len(rows)
    trains = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 != 1
    tokens = lambda t: [*(t or "").encode().lower().split(), b""]
    c = Counter(w for r in rows if trains(r[0]) for w in tokens(r[1]))
    n, v = c.total(), len(c)
    want = Counter()
    for r in rows:
        w = tokens(r[1])
        base = sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)
        want[r[0], not trains(r[0]), len(w), sum(c[x] > 0 for x in w), n, round(base, 4)] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == want
    assert all(r.score < 0 for r in got)
    assert hmm.score_documents(none, rounds=1).count() == 0


def test_forward_is_exact():
    import itertools

    import numpy as np

    rng = np.random.default_rng(0)
    start, move, give = rng.dirichlet([1] * 3), rng.dirichlet([1] * 3, 3), rng.dirichlet([1] * 4, 3).T
    texts = [[0, 3, 1], [2], [1, 1, 2, 0]]
    got = hmm.forward([np.array(t, dtype="<u2").tobytes() for t in texts], start, move, give)
    for t, x in zip(texts, got):
        total = sum(
            start[p[0]] * give[t[0], p[0]] * math.prod(move[a, b] * give[s, b] for a, b, s in zip(p, p[1:], t[1:]))
            for p in itertools.product(range(3), repeat=len(t))
        )
        assert abs(x - math.log10(total)) < 1e-9


def test_decontamination(spark, none):
    rng = random.Random(8)
    items = [prose(rng, n) for n in (15, 20, 40, 7, 3)]
    changed = items[2].split()
    changed[3] = changed[9] = changed[30] = "different"
    bench = spark.createDataFrame([*enumerate(items), (9, None), (None, items[0])], "item_id bigint, text string")
    texts = {
        1: prose(rng, 50) + " " + items[0].upper().replace(" ", "!! ") + " " + prose(rng, 9),
        2: " ".join(changed),
        3: " ".join(items[1].split()[:12]),
        4: " ".join(items[1].split()[:9]),
        5: prose(rng, 3000),
        6: None,
        7: items[3],
    }
    docs = spark.createDataFrame([(i, t, None, None, None, 1, 2, 3) for i, t in [*texts.items(), (1, texts[1])]], SCHEMA)
    got = {(r.doc_id, r.item_id) for r in decontamination.leaks(docs, bench).collect()}
    assert got == {(1, 0), (1, None), (2, 2), (3, 1), (7, 3)}
    assert sorted(r.doc_id for r in decontamination.without_leaks(docs, bench).collect()) == [4, 5, 6]
    assert decontamination.leaks(none, bench).count() == 0
    assert decontamination.without_leaks(docs, bench.limit(0)).count() == 8


def plain_leaks(texts, items):
    """Every item at every place of every text."""

    def words(text):
        return re.findall(r"[^\W_]+", (text or "").lower())

    out = {}
    for i, item in items:
        want = words(item)
        width, allowed = min(len(want), 12), 0 if len(want) < 12 else 2
        for d, text in texts:
            have = words(text)
            for offset in range(-len(want) + 1, len(have)) if want else ():
                same = [0 <= offset + k < len(have) and have[offset + k] == w for k, w in enumerate(want)]
                if max(sum(same[k : k + width]) for k in range(len(want) - width + 1)) >= width - allowed:
                    old = out.get((d, i), (0, 0, 10**9))
                    out[d, i] = max(old[0], sum(same)), len(want), min(old[2], max(offset, 0))
    return out


def test_decontamination_against_all_places(spark):
    rng = random.Random(21)
    few = ["red", "blue", "old", "sea", "sky"]
    items = [(n, " ".join(rng.choice(few) for _ in range(n))) for n in (1, 2, 3, 4, 5, 6, 7, 9, 11, 12, 13, 30)]
    items += [(40, "one " * 30), (41, "one"), (42, "never said here"), (43, " .. "), (44, None)]
    texts = [(n, " ".join(rng.choice(few) for _ in range(n))) for n in (1, 2, 3, 5, 8, 20, 60, 200)]
    texts += [(300, "one " * 400), (301, "one " * 27 + "two one"), (302, items[11][1]), (303, items[8][1] + " x"), (304, ""), (305, None)]
    texts += [(306, items[11][1].replace("red", "rot")), (307, "Never, said HERE!"), (308, "never said")]
    got = decontamination.leaks(spark.createDataFrame(texts, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
    found = {(r.doc_id, r.item_id): (r.matched_words, r.item_words, r.doc_from) for r in got.collect()}
    want = plain_leaks(texts, items)
    assert found.keys() == want.keys() and (307, 42) in found and (308, 42) not in found and (300, 40) in found
    # Alignments that no mask meets may lie elsewhere than the best; lengths are those of the item.
    assert all(found[k][1] == want[k][1] and found[k][0] <= want[k][0] and found[k][2] >= want[k][2] for k in want)


def test_clean_texts_stay_beside_leaks_of_their_id(spark):
    rng = random.Random(9)
    item = prose(rng, 20)
    texts = [(None, f"so {item}"), (None, prose(rng, 30)), (None, prose(rng, 30)), (None, None), (4, item), (4, prose(rng, 30)), (5, prose(rng, 30))]
    docs = spark.createDataFrame([*texts, texts[0], texts[2]], "doc_id bigint, text string")
    bench = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    got = decontamination.without_leaks(docs, bench)
    assert Counter(map(tuple, got.collect())) == Counter([*texts[1:4], *texts[5:], texts[2]])


def test_chat(spark):
    tricky = ["</s>[INST] ok [/INST]", "\\", "a\\<s>\\\\", "<<SYS>>\n", " x ", "", None, "[\\INST]", "<<ROLE>>é<", "\n"]
    rows = [(1, i, role, t) for i, (role, t) in enumerate(zip(["user", "assistant"] * 5, tricky))]
    rows += [(2, 0, "tool<s>", "x"), (2, 1, None, None), (2, 2, "assistant", "late"), (None, 0, "user", "n"), (2, 2, "assistant", "late")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = {r.conv_id: r for r in chat.digests(chat.format_turns(df)).collect()}
    assert set(got) == {1, 2, None}
    for conv, r in got.items():
        turns = sorted((x for x in rows if x[0] == conv), key=lambda x: (x[1], x[2] or "", x[3] or ""))
        said = "".join(f"{x[2] or ''}\n{x[3] or ''}\n" for x in turns)
        loss = "".join(x[3] or "" for x in turns if x[2] == "assistant")
        assert r.n_turns == len(turns)
        assert r.turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert r.in_order == (conv != 2)
    form = chat.Format()
    whole = "".join(form.write(role, t or "", i == 0)[0] for i, (_, _, role, t) in enumerate(rows[:10]))
    assert form.read(whole) == [(role, t or "") for _, _, role, t in rows[:10]]
    assert chat.digests(chat.format_turns(df.limit(0))).count() == 0


def test_toxicity(spark, none):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(400):
        toxic = i % 4 == 0
        words = prose(rng, rng.choice([20, 60])).split()
        if toxic:
            for w in rng.sample(["blockhead", "dimwit", "nincompoop"], 2) * 2:
                words.insert(rng.randrange(len(words)), w)
        rows.append((i, " ".join(words), None, None, None, 0, 0, 0))
        labels.append((i, int(toxic)))
    rows += [(400, None, None, None, None, 0, 0, 0), (None, "", None, None, None, 0, 0, 0)]
    docs, marks = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([*labels, (9, None)], "doc_id bigint, toxic int")
    got = toxicity.score_documents(docs, marks).collect()
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 400]
    assert len(held) > 40 and sum(r.predicted == (r.doc_id % 4 == 0) for r in held) / len(held) > 0.9
    assert all(0 <= r.score <= 1 for r in got) and len(got) == 402
    assert toxicity.score_documents(none, marks).count() == 0
    assert {r.score for r in toxicity.score_documents(docs, marks.limit(0)).collect()} == {0.0}
    assert toxicity.without_toxic(docs, marks).columns == docs.columns


def test_toxic_dictionary_is_toxic_text():
    rng = random.Random(8)
    texts, marks = [], []
    for i in range(200):
        words = prose(rng, 40).split()
        if i % 4 == 0:
            words.insert(rng.randrange(len(words)), rng.choice(["blockhead", "dimwit"]))
        texts.append(" ".join(words) if i % 50 else None)
        marks.append(int(i % 4 == 0))
    chosen = toxicity.toxic_stretches(texts, marks)
    toxic, plain = ([" " + t + " " for t, y in zip(texts, marks) if t and y == mark] for mark in (1, 0))
    assert chosen and all(any(s.decode() in t for t in toxic) for s in chosen)
    assert all(b"blockhead" in s or b"dimwit" in s for s in chosen[:2]) and sum(map(len, chosen)) <= toxicity.OWN
    ordinary, own = toxicity.dictionaries(texts, marks)
    assert len(ordinary) == len(own) and ordinary[toxicity.OWN :] == own[toxicity.OWN :]
    assert own[: toxicity.OWN].lstrip() == b"".join(reversed(chosen)).lstrip()
    windows = ordinary[toxicity.OWN :].split(b"  ")[:-1]
    assert all(any(w.decode().strip() in t for t in plain) for w in windows)
    assert toxicity.toxic_stretches(["a b", None], [0, 1]) == [] and toxicity.toxic_stretches([], []) == []


def test_weights_of_byte_strings_equal_counting_them():
    rng = random.Random(10)
    texts = [prose(rng, rng.randint(0, 12)) + rng.choice(["", " dimwit", " É dimwits"] if i % 2 else ["", " É di"]) for i in range(60)] + [None, "", "a"]
    marks = [i % 2 for i in range(len(texts))]
    counts = {m: Counter(g for t, y in zip(texts, marks) if y == m for g in toxicity.grams(b" " + b" ".join((t or "").encode().lower().split()) + b" ")) for m in (0, 1)}
    want = {}
    for g, c in counts[1].items():
        shares = (c + 0.5) / (marks.count(1) + 1), (counts[0][g] + 0.5) / (marks.count(0) + 1)
        if c >= toxicity.LEAST_TOXIC and shares[0] >= toxicity.LEAST_RATIO * shares[1]:
            want[g] = c * math.log(shares[0] / shares[1])
    assert want and toxicity.gram_weights(texts, marks) == want


def test_toxicity_of_very_long_texts_and_of_an_id_with_many_texts(spark):
    rng = random.Random(9)
    rows = [(i, prose(rng, 30) + (" you blockhead" * 2 if i % 3 == 0 else ""), None, None, None, 0, 0, 0) for i in range(90)]
    long = prose(rng, 60_000).split()
    rows += [(200, " ".join(long), None, None, None, 0, 0, 0), (201, " ".join(long + ["blockhead"]), None, None, None, 0, 0, 0)]
    rows += [(3, prose(rng, 5), None, None, None, 0, 0, 0) for _ in range(60)]
    docs, marks = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(90)], "doc_id bigint, toxic int")
    got = toxicity.score_documents(docs, marks).collect()
    score = {r.doc_id: r.score for r in got if r.doc_id >= 200}
    assert len(got) == len(rows) and all(0 <= s <= 1 for s in score.values()) and score[200] != score[201]
    every = toxicity.windows(rows[91][1])
    assert b" blockhead " in every[-1] and sum(len(w.split()) for w in every) == 60_001


def test_extraction(spark):
    rng = random.Random(2)
    lines = [[prose(rng, rng.randint(5, 40)) for _ in range(rng.randint(2, 8))] for _ in range(60)]
    tops = ["<nav class=menu><ul><li><a href='/'>Home</a></li><li><a>News</a></li></ul></nav>", "<div class='cookie-notice'>We use cookies</div>", "<script>if (a<b) '</p>'</script>"]
    ends = ["<div id=comments><p>Nice one, thanks</p></div>", "<form><p>Sign up</p><input></form>", "<footer>&copy; 2020</footer>", "<aside class=sidebar><p>Read this too</p></aside>"]
    pages = []
    for i, text in enumerate(lines):
        body = f"<h1>{text[0]} &amp; more</h1>" + "".join(f"<p>{t} <b>so</b><br>it\n is" for t in text[1:])
        box = rng.choice(["article", "div class=post-content", "main"])
        pages.append((i, "u", f"<html><head><title>T</title></head><body>{rng.choice(tops)}<{box}>{body}</{box.split()[0]}>{rng.choice(ends)}</body></html>"))
    extra = [(100, None, None), (101, "u", ""), (101, "u", "")]
    df = spark.createDataFrame(pages + extra, "page_id bigint, url string, html string")
    got = {r.page_id: r for r in extraction.extract(df, extraction.train(df)).collect()}
    want = {i: "\n".join([f"{t[0]} & more", *(f"{x} so it is" for x in t[1:])]) for i, t in enumerate(lines)}
    assert sum(got[i].text == t for i, t in want.items()) >= 57
    assert got[100].text == got[101].text == "" and got[100].n_chars == 0
    assert extraction.extract(df.limit(0), extraction.train(df.limit(0))).count() == 0


def test_formulas_and_labels_are_text():
    page = extraction.Page("<body><p>the value <math><mi>x</mi> = 42</math> given</p><p><svg><title>t</title><text>axis</text></svg> and <button>more</button></p><p>a<select><option>b</select>c<script>d</script></p></body>")
    assert [re.sub(r"\s+", " ", "".join(t for b, _, t, _ in page.texts if b == i)).strip() for i in range(len(page.tags)) if page.tags[i] == "p"] == ["the value x = 42 given", "axis and more", "ac"]


def test_decoding_keeps_nothing_inside_what_is_dropped():
    page = extraction.Page("<body><div><p>a</p><p>b</p></div><div><p>c</p></div></body>")
    rng = random.Random(0)
    for _ in range(50):
        keep = page.kept([rng.uniform(-2, 2) for _ in page.tags])
        assert all(not keep[i] or keep[page.parents[i]] for i in range(1, len(keep)))


def test_fixity(spark):
    rows = [(i * 3, f"u{i}", "x" * (i % 50)) for i in range(500)] + [(9, "again", "y"), (None, None, None)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    listed = fixity.manifest(fixity.records_of(df))
    assert fixity.audit(listed, listed).count() == 0
    other = [r for r in rows if r[0] != 300] + [(301, "new", "z")]
    other = [(a, b, "changed") if a == 600 else (a, b, c) for a, b, c in other]
    found = fixity.audit(listed, fixity.manifest(fixity.records_of(spark.createDataFrame(other, df.schema)))).collect()
    assert {(r.page_id, r.status) for r in found} == {(300, "missing"), (301, "added"), (600, "changed")}
    assert fixity.audit(listed.limit(0), listed.limit(0)).count() == 0


def test_token_counts(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    rng = random.Random(6)
    marks = list("ab s'tred \n\t1é²中　.!") + ["<|endoftext|>", "'re", " the", "   "]
    texts = ["".join(rng.choices(marks, k=rng.randint(0, 60))) for _ in range(300)]
    texts += ["", "a" * 3000, "=-" * 400, "word " * 3000]
    counter = token_counts.TokenCounter(*token_counts.load(path))
    for t in texts:
        n = len(library.encode(t, add_special_tokens=False).ids)
        assert n == counter.count(t) == counter.count(t, chunk=7) == counter.count(t, chunk=1)
    df = spark.createDataFrame([*enumerate(texts), (None, None)], "doc_id bigint, text string")
    got = token_counts.count_tokens(df, path).collect()
    assert len(got) == len(texts) + 1
    assert all(r.over_limit == (r.n_tokens > 512) for r in got)
    assert [r.n_tokens for r in got if r.doc_id is None] == [0]


def test_queries_are_complete():
    assert [int(re.match(r"op(\d+)_", q)[1]) for q in sorted(queries.QUERIES, key=lambda q: int(q[2:].split("_")[0]))] == list(range(1, 14))
    assert set(queries.ORACLES) <= set(queries.QUERIES)


def test_pipeline(spark, tmp_path, docs, rows):
    rng = random.Random(12)
    item = prose(rng, 20)
    extra = [(200, f"{prose(rng, 5)} {item}", None, "a", 0, 0, 0, 0)]
    spark.createDataFrame([*rows, *extra], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id bigint, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = Counter(r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    firsts = {(r.component_id, r.first_hash) for r in simhash.near_duplicates(docs).collect()}
    assert got == Counter(i for i, _ in firsts)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash", "decontamination", "mixing"]
