"""Each operator against brute force on small rows with every odd case."""

import collections
import dataclasses
import hashlib
import itertools
import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from hearthscore.llm import chat, dom, exact_dedup, html_extract, langid, licenses, line_quality
from hearthscore.llm import packing, pieces, sharding, simhash
from hearthscore.llm.components import components


def test_exact_dedup(odd):
    rows = exact_dedup.mark_duplicates(odd.drop("id", "digest")).collect()
    assert len(rows) == odd.count()
    same = [r for r in rows if r.text_sha256 == hashlib.sha256(b"same text").hexdigest()]
    assert len(same) == 4 and {r.keep_id for r in same} == {4} and {r.group_size for r in same} == {4}
    assert [r.doc_id for r in same if r.kept] == [4]
    empty = [r for r in rows if r.doc_id in (1, 2)]
    assert {r.keep_id for r in empty} == {2}
    kept = exact_dedup.drop_duplicates(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 4, 5, 6, 7, 8, 9]
    assert exact_dedup.mark_duplicates(odd.limit(0)).count() == 0


def test_sharding(spark, odd):
    rows = odd.withColumn("size", F.octet_length(F.coalesce("text", F.lit(""))) + 8)
    out = sharding.shard_rows(rows, 3, "size", F.xxhash64("text"), F.col("doc_id")).collect()
    assert len(out) == odd.count()
    for shard in {r.shard for r in out}:
        slots = sorted(r.slot for r in out if r.shard == shard)
        assert slots == list(range(len(slots)))
    even = spark.range(20000).selectExpr("id", "id % 7000 as g", "cast(10 + id % 5 as long) as size")
    sums = collections.Counter()
    for r in sharding.shard_rows(even, 8, "size", F.col("g"), F.col("id")).collect():
        sums[r.shard] += r["size"]
    assert max(sums.values()) < 1.03 * sum(sums.values()) / 8 and len(sums) == 8
    one = spark.range(9000).selectExpr("1 as id", "1 as g", "cast(10 as long) as size")  # one key
    shards = sharding.shard_rows(one, 3, "size", F.col("g"), F.col("id")).groupBy("shard").count()
    assert max(r["count"] for r in shards.collect()) < 3200
    assert sharding.shard_rows(even.limit(0), 8, "size", F.col("g"), F.col("id")).count() == 0


def test_sharding_with_one_large_row(spark):
    rows = spark.range(20000).selectExpr(
        "id", "if(id % 3 = 0, -1, id) as g", "cast(if(id = 500, 2400, 10 + id % 5) as long) as size"
    )
    sums = collections.Counter()
    for r in sharding.shard_rows(rows, 24, "size", F.col("g"), F.col("id")).collect():
        sums[r.shard] += r["size"]
    share = sum(sums.values()) / 24
    assert len(sums) == 24 and max(abs(n - share) for n in sums.values()) < 0.021 * share


def test_links_and_components(spark):
    rng = random.Random(3)
    marks = [rng.getrandbits(64) for _ in range(300)]
    for m in marks[:150]:
        for _ in range(rng.randint(1, 4)):
            m ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5)))
            marks.append(m)
    marks = sorted({m - (1 << 64) if m >> 63 else m for m in marks})
    df = spark.createDataFrame([(m,) for m in marks], "fp long")
    got = {(r.u, r.v) for r in simhash.links(df).collect()}
    u = np.array(marks, dtype=np.int64)
    want = set()
    for i, j in itertools.combinations(range(len(u)), 2):
        if bin((marks[i] ^ marks[j]) & (2**64 - 1)).count("1") <= 4:
            want.add((marks[j], marks[i]))
    assert got == want and len(want) > 100
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "u long, v long")
    roots = {r.node: r.root for r in components(chain).collect()}
    assert {roots[i] for i in range(41)} == {0} and roots[101] == 100


def test_links_are_not_broadcast(spark):
    """Every fingerprint makes 70 keys, of which Spark's estimate knows nothing."""
    df = spark.range(1000).select(F.xxhash64("id").alias("fp"))
    plan = simhash.links(df)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_near_duplicates(odd):
    out = simhash.near_duplicates(odd.drop("id", "fp")).collect()
    assert len(out) == odd.count()
    of = {r.doc_id: r for r in out}
    assert of[1].fingerprint == "0" * 16 and of[2].component_id == 1
    assert of[7].component_id == of[6].component_id == 6
    kept = sorted(r.doc_id for r in simhash.keep_one(odd).collect())
    assert kept == [1, 3, 5, 6, 8, 9]
    assert simhash.near_duplicates(odd.limit(0)).count() == 0


def plain_fingerprint(text):
    """The contract of the SimHash query, word by word."""
    words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    if not words:
        return 0
    hashes = [
        xxhash.xxh64(" ".join(words[i : i + 4]).encode(), seed=42).intdigest() for i in range(max(1, len(words) - 3))
    ]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_texts():
    """Texts with copies of one to four per cent changed words, one group of them large."""
    rng = random.Random(9)
    word = lambda: f"{rng.getrandbits(32):x}"
    passage = [word() for _ in range(40)]
    texts = [[*passage, *(word() for _ in range(40))] for _ in range(80)]  # one passage in many texts
    for n, copies in ((12, 3), (50, 3), (100, 3), (300, 3)) * 12 + ((400, 150),):
        first = [word() for _ in range(n)]
        texts.append(first)
        for _ in range(copies):
            copy = list(first)
            for i in rng.sample(range(n), max(1, n * rng.choice((1, 2, 4)) // 100)):
                copy[i] = word()
            texts.append(copy)
    return [" ".join(t) for t in texts]


def plain_roots(marks):
    """Smallest reachable index over fingerprints within four bits."""
    root = list(range(len(marks)))
    for i, j in itertools.combinations(range(len(marks)), 2):
        if (marks[i] ^ marks[j]).bit_count() <= 4 and root[i] != root[j]:
            a, b = sorted((root[i], root[j]))
            root = [a if r == b else r for r in root]
    return root


def test_near_duplicate_stage_against_brute_force(spark):
    import corpus_pipeline

    texts = near_texts() + ["", None, "Same Text", "same text"]
    marks = [plain_fingerprint(t) for t in texts]
    root = plain_roots(marks)
    assert len(set(root)) < len(texts) - 50
    rows = [(i, t, "x") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows + rows[::7], "doc_id long, text string, fp string").repartition(6)
    out = [r.doc_id for r in corpus_pipeline.near_duplicates(spark, df, "").collect()]
    assert sorted(out) == sorted(set(root))
    found = {r.doc_id: r for r in simhash.near_duplicates(df.drop("fp")).collect()}
    assert [int(found[i].fingerprint, 16) for i in range(len(texts))] == marks
    assert [found[i].component_id for i in range(len(texts))] == root


def test_best_boundaries_against_all_choices():
    rng = np.random.default_rng(1)
    for _ in range(20):
        lengths = np.sort(rng.choice(60, 9, replace=False)) + 1
        counts = rng.integers(1, 50, 9)

        def padding(bounds):
            return sum(c * (min(b for b in bounds if b >= n) - n) for n, c in zip(lengths, counts))

        got = padding(packing.best_boundaries(lengths, counts, 4))
        choices = itertools.combinations(lengths[:-1].tolist(), 3)
        assert got == min(padding([*c, int(lengths[-1])]) for c in choices)


def test_pack(odd):
    sized = odd.select("doc_id", packing.word_count("text").alias("n"))
    s = packing.PackSettings(max_len=64, buckets=3, budget=256)
    out = packing.pack(sized, "doc_id", "n", s).collect()
    tokens = collections.Counter()
    for r in out:
        tokens[r.doc_id] += r.n_tokens
    assert tokens[5] == 24000 and tokens[6] == 300 and tokens[1] == 0
    batches = collections.defaultdict(list)
    for r in out:
        if r.batch_id is not None:
            batches[r.batch_id].append(r)
    assert all(len(b) * b[0].bucket_len <= 256 and len({r.bucket_len for r in b}) == 1 for b in batches.values())
    assert packing.pack(sized.limit(0), "doc_id", "n", s).count() == 0


def test_line_quality(spark, odd):
    out = {r.id: r for r in line_quality.judge(odd.drop("id")).collect()}
    assert not out[1].kept and out[1].n_words == 0 and out[6].kept and not out[5].kept
    rng = random.Random(5)
    words = lambda n: " ".join(f"{rng.getrandbits(40):x}" for _ in range(n))
    menu = words(200)
    rows = [(i, f"Menu  of the SITE {menu}\n" + words(60), "a") for i in range(40)]
    body = words(80) + "\n" + words(80)
    rows += [(100 + i, body + f"\n{i}", "b") for i in range(40)]  # near copies are not boilerplate
    rows += [(200, "menu of the site " + menu, "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("n_chars", F.length("text"))
    out = {r.id: r for r in line_quality.judge(df).collect()}
    assert all(out[i].n_removed_words == 204 and not out[i].kept for i in range(40))
    assert all(out[100 + i].kept and out[100 + i].n_removed_words == 0 for i in range(40))
    assert line_quality.repeated_words("a b c a b c x".encode().split()) == 6
    assert line_quality.filter_documents(df.limit(0)).count() == 0


def test_line_quality_of_several_shared_lines(spark):
    rng = random.Random(6)
    words = lambda n: " ".join(f"{rng.getrandbits(40):x}" for _ in range(n))
    shared = [words(n) for n in (12, 30, 8, 25, 15)]
    text = lambda own: "\n".join([*shared[:3], words(own), *shared[3:]])
    rows = [(i, text(80), "a") for i in range(60)] + [(100 + i, text(20), "a") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    df = df.withColumn("n_chars", F.length("text"))
    out = {r.id: r for r in line_quality.judge(df).collect()}
    assert all(r.n_removed_words == 90 for r in out.values())
    assert all(out[i].kept and not out[100 + i].kept for i in range(60))  # 20 of 110 words: depleted
    left = line_quality.filter_documents(df).collect()
    assert len(left) == 60 and all("\n" not in r.text for r in left)


def plain_quality(rows, s=line_quality.LineSettings()):
    """Kept, removed words and text left per row, by the rules in plain Python."""
    norm = lambda line: " ".join(re.findall("[^\x20\x09-\x0d]+", line)).lower()
    root = plain_roots([plain_fingerprint(t) for _, t, _ in rows])
    hosts, lines = collections.defaultdict(set), collections.defaultdict(set)
    for (_, text, host), r in zip(rows, root):
        hosts[host].add(r)
        for line in text.split("\n"):
            if norm(line):
                lines[host, norm(line)].add(r)
    out = []
    for _, text, host in rows:
        def often(line):
            n = len(lines[host, norm(line)])
            return n > s.min_docs and n * 100 > len(hosts[host]) * s.min_doc_pct
        gone = [x for x in text.split("\n") if norm(x) and often(x)]
        words, removed = len(text.split()), sum(len(x.split()) for x in gone)
        windows = collections.Counter(zip(text.split(), text.split()[1:], text.split()[2:]))
        ids = [w for w in zip(text.split(), text.split()[1:], text.split()[2:])]
        covered = {i + k for i, w in enumerate(ids) if windows[w] > 1 for k in range(3)}
        base = words < 50 or 100 * len(covered) > 50 * words
        kept = not base and (words - removed) * 100 >= words * s.min_left_pct
        out.append((base, kept, removed, "\n".join(x for x in text.split("\n") if x not in gone)))
    return out


def test_line_quality_against_brute_force(spark):
    rng = random.Random(11)
    words = lambda n: " ".join(f"{rng.getrandbits(40):x}" for _ in range(n))
    shared = [words(75) for _ in range(3)]
    rows = [("\n".join([*shared, words(5)]), "a") for _ in range(40)]  # depleted, and alike
    rows += [("\n".join([*shared, words(120)]), "a") for _ in range(20)]
    body = [words(30) for _ in range(8)]
    for i in range(60):  # near copies of one text, one word changed
        lines = [x.split() for x in body]
        lines[i % 8][i % 30] = words(1)
        rows.append(("\n".join(map(" ".join, lines)), "b"))
    menu = "Home  About CONTACT"
    rows += [(menu + "\n" + words(90), "b") for _ in range(30)] + [(words(20), "c"), ("x y z " * 60, "c"), ("", "c")]
    rows = [(i, t, h) for i, (t, h) in enumerate(rows)]
    want = plain_quality(rows)
    df = spark.createDataFrame([(*r, len(r[1]), "k") for r in rows], "doc_id long, text string, source string, n_chars long, kept string")
    got = {r.id: r for r in line_quality.judge(df.repartition(5)).collect()}
    for i, (base, kept, removed, _) in enumerate(want):
        assert (got[i].base_failed, got[i].kept, got[i].n_removed_words) == (base, kept, removed), i
    assert not any(got[i].kept for i in range(40)) and all(got[i].kept for i in range(40, 150))
    assert all(got[i].n_removed_words == 0 for i in range(60, 120)) and got[130].n_removed_words == 3
    left = {r.doc_id: r for r in line_quality.filter_documents(df).collect()}
    assert {i: r.text for i, r in left.items()} == {i: w[3] for i, w in enumerate(want) if w[1]}
    assert all(r.n_chars == len(r.text) and r.kept == "k" for r in left.values())


def test_marks_are_no_letters():
    grams = langid._word_grams
    assert [len(x) for x in grams("\u2764\ufe0f 12")] == [0, 0, 0, 0]
    starts, lengths, _, found = grams("\u0301abc d\u0301e \ufe0f")
    assert starts.tolist() == [1, 5] and lengths.tolist() == [3, 3] and len(found) == 6
    assert (grams("\ufe0fabc")[3] == grams("\x00abc")[3]).all()


def test_language(odd, spark):
    train = spark.createDataFrame(
        [(1, "the cat and the dog went to the house", "en"), (2, "der hund und die katze gehen in das haus", "de"),
         (3, "кот и собака идут домой", "ru")] * 5, "doc_id long, text string, lang string")
    model = langid.fit(train, "text", "lang")
    got = langid.spans(model, [None, "…", "the dog and the cat " * 9 + "und die katze in das haus " * 5, "собака"])
    assert got[0][0] == got[1][0] == "und" and got[3][0] == "ru"
    assert [x for _, x in got[2][2]] == ["en", "de"] and got[2][0] == "en"
    scores = [np.random.default_rng(i).normal(size=(n, 3)) * 9 for i, n in enumerate((0, 1, 5, 6))]
    for s, labels in zip(scores, langid.viterbi(scores, 4.0)):
        paths = itertools.product(range(3), repeat=len(s))
        value = lambda p: sum(s[i][x] for i, x in enumerate(p)) - 4.0 * sum(a != b for a, b in zip(p, p[1:]))  # noqa: B023,E731
        assert tuple(labels.tolist()) == max(paths, key=value)
    assert langid.label_documents(odd, model, "doc_id", "text").count() == odd.count()


def test_pieces_chunked_equals_whole(spark, odd, monkeypatch):
    from hearthscore.llm.queries import PIECES, TOKENIZERS

    v = pieces.read_vocabulary(f"{TOKENIZERS}/{PIECES}")
    encoder, rng = pieces.Encoder(v), random.Random(1)
    parts = ["a", "th", " ", "  ", "\n", "é", "ing", "▁", "中", "tion", "x" * 20, " the"]
    for _ in range(150):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 50)))
        full, c, w = " " + text, rng.randint(16, 30), v.longest
        best, last = pieces._forward(v, full, len(full), {0: 0})
        want = pieces._trace(v, full, last, len(full))[0]
        cells = [pieces.Chunk(encoder, full[i : i + c], full[i + c : i + c + w - 1]) for i in range(0, len(full), c)]
        x, entries = np.array([[0] + [pieces.NEVER] * (w - 1)]), []
        for cell in cells:
            entries.append(x[0].tolist())
            x = pieces.max_plus(x, cell.matrix())
        over, out = 0, []
        for cell, entry in zip(cells[::-1], entries[::-1]):
            ids, start = cell.encode(entry, over)
            assert cell.entries(entry)[over] == start
            out, over = ids + out, start
        assert out == want == encoder.whole(text)
    monkeypatch.setattr(pieces, "CHUNK_CHARS", 1000)
    monkeypatch.setattr(pieces, "SCAN_WIDTH", 4)
    back = collections.defaultdict(dict)
    for r in pieces.decode(pieces.encode(odd.where("doc_id > 4"), v), v).collect():
        back[r.id][r.chunk] = r.text
    for r in odd.where("doc_id > 4").collect():
        assert "".join(t for _, t in sorted(back[r.doc_id].items())) == (r.text or "")


@pytest.mark.parametrize("broadcast", [True, False])
def test_pieces_round_trip(spark, odd, monkeypatch, broadcast):
    """Nulls, empty, giant and repeated texts, clashing names; a wrong spelling is seen."""
    from hearthscore.llm.queries import PIECES, TOKENIZERS

    v = pieces.read_vocabulary(f"{TOKENIZERS}/{PIECES}")
    monkeypatch.setattr(pieces, "CHUNK_CHARS", 1000)
    monkeypatch.setattr(pieces, "SCAN_WIDTH", 4)
    if not broadcast:
        monkeypatch.setattr(pieces, "BROADCAST_UNITS", 0)
    giant = "ein paar Wörter\t▁中  " * 300
    more = spark.createDataFrame([(7, giant), (7, giant + "x"), (None, giant), (8, "\x00\n")], "doc_id long, text string")
    docs = odd.withColumns({"unit": F.lit(1), "source": F.lit("x")}).unionByName(more, allowMissingColumns=True)
    rows = pieces.round_trip(docs, v).collect()
    assert all(r.round_trip for r in rows)
    got = collections.Counter((r.id, r.spelled) for r in rows if r.chunk == 0)
    texts = [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]

    def by_digits(text):
        number = 0
        for byte in text.encode():
            number = (number * 256 + byte) % (2**128 - 159)
        return f"{number:032x}-{len(text.encode())}"

    assert got == collections.Counter((i, by_digits(t)) for i, t in texts)
    whole = {(r.id, r.spelled): r.ids for r in rows if r.n_chunks == 1}
    for i, t in texts:
        key = (i, by_digits(t))
        assert key not in whole or pieces.decode_ids(v, True, whole[key]) == t
    assert pieces.round_trip(docs.limit(0), v).count() == 0


def test_a_wrong_spelling_is_seen(spark):
    from hearthscore.llm.queries import PIECES, TOKENIZERS

    v = pieces.read_vocabulary(f"{TOKENIZERS}/{PIECES}")
    lossy = dataclasses.replace(v, byte_ids=v.byte_ids[1:] + v.byte_ids[:1])
    short = pieces._parts(spark.createDataFrame([(1, "ab𓀀")], "doc_id long, text string"), v, "doc_id", "text")[0]
    (row,) = short.select("ids", "source").collect()
    for vocabulary, right in ((v, True), (lossy, False)):
        (raw,) = pieces._spell(vocabulary, pa.array([True]), pa.array([row.ids], pa.list_(pa.int32())))
        assert (pieces.fingerprint([raw]) == row.source) == right
    whole = pieces.fingerprint([b"ab", b"", b"c" * 300])
    assert whole == pieces.fingerprint([b"ab" + b"c" * 300]) != pieces.fingerprint([b"ba" + b"c" * 300])


def test_chat(spark):
    for text in ("<|im_end|>", "a<\\|b", "<", "|>", "<\\\\|im_start|>", "\n<|"):
        t = chat.ChatTemplate()
        whole = "".join(s for s, _ in chat.turn_segments(t, "as%0A<|\nx", text))
        assert chat.read_turns(t, whole) == [("as%0A<|\nx", text)]
    rows = [(1, 0, "user", None), (1, 1, "assistant", "A<|im_end|>"), (2, 0, "assistant", "x"),
            (None, None, None, None), (1, 1, "assistant", "A<|im_end|>")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("conv", F.lit(1))
    out = {r.conv: r for r in chat.conversation_digests(chat.format_turns(df)).collect()}
    assert out[1].n_turns == 3 and out[1].loss_chars == 22 and not out[1].valid and not out[2].valid
    want = "user\n\n" + "assistant\nA<|im_end|>\n" * 2
    assert out[1].turns_sha256 == hashlib.sha256(want.encode()).hexdigest()
    assert chat.conversation_digests(chat.format_turns(df.limit(0))).count() == 0


def test_licenses(odd):
    index = licenses.fit_index(odd)
    out = {r.doc_id: r for r in licenses.scan_licenses(odd, index).collect()}
    assert out[9].n_base == 2 and (out[9].first_word, out[9].last_word) == (0, 2) and out[9].base_labels == "mit"
    assert out[1].n_words == 0 and out[1].first_word is None and out[1].labels == ""
    text = b"x y Permission is hereby granted, free of charge, to any person obtaining a copy of this software" \
           b" and associated documentation files (the Software), to deal in the Software without restriction"
    assert "mit-grant" in licenses.scan(index, text)[5]
    assert licenses.scan(index, b"Licensed under CC BY-NC 4.0.")[5] == "cc-by-nc-4.0"


def test_html(spark):
    page = dom.parse("<p>a<b>b<p>c &amp; d<br>e<!-- x --><script>1<2</script><ul><li>f<li>g</ul><a href='cut")
    assert dom.blocks(page, [True] * len(page.elements)) == ["ab", "c & d e", "f", "g"]
    odds = np.array([1.0 if e.tag != "ul" else -9.0 for e in page.elements])
    kept = dom.decode(page, odds)
    assert all(kept[e.parent] for e, k in zip(page.elements, kept) if k and e.parent >= 0)
    assert dom.blocks(page, kept) == ["ab", "c & d e"]
    rng = random.Random(7)
    text = [" ".join(f"word{rng.randint(0, 999)}" for _ in range(40)) + "." for _ in range(6)]
    pages = [(i, html_extract.synthetic_page(random.Random(i), text)) for i in range(40)]
    df = spark.createDataFrame([*pages, (90, None), (91, "")], "page_id long, html string")
    model = html_extract.fit(df, train_pages=20)
    right = total = 0
    for i in range(100, 140):
        made = dom.parse(html_extract.synthetic_page(random.Random(i), text))
        truth = html_extract._exact_labels(made)
        kept = dom.decode(made, model.log_odds(dom.features(made)))
        total += len(truth)
        right += sum(int(k) == y for k, y in zip(kept, truth))
    assert right / total > 0.9
    out = {r.page_id: r.text for r in html_extract.extract_pages(df, model).collect()}
    assert out[90] == out[91] == ""


@pytest.mark.parametrize("tags", ["<div>", "<div><p>x", "<b>", "<ul><li>", "<svg>", "</div>", "<table><tr><td>x", "<!-->"])
def test_html_parse_is_linear(tags):
    start = time.process_time()
    dom.parse(tags * 8000, marked=False)
    assert time.process_time() - start < 2  # the square would take ten seconds and more


def test_html_of_real_pages():
    def texts(source):
        page = dom.parse(source, marked=False)
        return dom.blocks(page, [True] * len(page.elements))

    for attribute in ('data-y="12.5"', "data-y", 'data-y-offset="5"'):
        assert texts(f"<p {attribute}>a</p>") == ["a"]
    assert dom.parse('<p data-y="0">a').elements[1].label == 0
    assert dom.parse('<p data-y-offset="5">a').elements[1].label is None
    assert texts("<html><head><title>t</title><meta charset=x>\n<div>a</div><p>b") == ["a", "b"]
    assert texts("<head><link href=x> bare text<p>b") == ["bare text", "b"]
    for tag in "svg select object canvas math audio video".split():
        assert texts(f"<p>a</p><{tag}><p>b</p><p>c</p>") == ["a", "b", "c"], tag
    assert texts("<p>a <svg><path d=x /><text>n</text></svg>b <select><option>n</select>c") == ["a b c"]
    assert texts("<!-->hello<p>world") == ["hello", "world"] and texts("<!--->a<!-- b --!>c") == ["ac"]
    assert texts("<p>so <math><mi>x</mi><mo>+</mo><mn>1</mn></math> it is</p>") == ["so x+1 it is"]


@pytest.mark.parametrize("name", ["op9_exact_dedup", "op13_filter_audit"])
def test_query_matches_sql(spark, sf, name):
    from compare import compare, duck

    from hearthscore.llm.queries import ORACLE, QUERIES

    assert compare(spark, duck(sf), QUERIES[name], ORACLE[name], sf) is None


CLASHES = ("id", "host", "text_key", "removed", "_host", "_key", "_removed", "_found", "_th", "th", "fp", "n",
           "digest", "_digest", "maybe", "_maybe", "_chosen", "_at", "_range", "_first", "k", "u", "kept", "_id")


def test_stages_pass_clashing_columns_unchanged(spark):
    import corpus_pipeline

    rng = random.Random(11)
    words = lambda n: " ".join(f"{rng.getrandbits(32):x}" for _ in range(n))
    menu = "one shared menu line"
    rows = [(i, f"{menu}\n{words(80)}", "en", "a", 0) for i in range(60)]
    rows += [(100, rows[0][1], "en", "a", 0), (101, rows[1][1] + " x", "en", "a", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    df = df.select("*", *[F.concat(F.lit(f"{c}-"), F.col("doc_id")).alias(c) for c in CLASHES])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, df, "")
        assert out.columns == df.columns, name
        got = out.collect()
        assert got and all(r[c] == f"{c}-{r.doc_id}" for r in got for c in CLASHES), name
        if name == "quality":
            assert len(got) == len(rows) and all(menu not in r.text and r.n_chars == len(r.text) for r in got)
        elif name == "exact_duplicates":
            assert len(got) == len(rows) - 1
    assert corpus_pipeline.STAGES[-1][1](spark, df, "").select("doc_id").distinct().count() == len(rows)
    sized = df.withColumn("size", F.octet_length("text"))
    shards = sharding.shard_rows(sized, 3, "size", F.xxhash64("text"), F.col("doc_id")).collect()
    assert len(shards) == len(rows) and all(r[c] == f"{c}-{r.doc_id}" for r in shards for c in CLASHES)


def test_pipeline_keeps_one_of_each(spark, sf):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = corpus_pipeline.run(spark, sf)
    ids = [r.doc_id for r in out.select("doc_id").distinct().collect()]
    assert 0 < len(ids) < docs.count() and [n for n, _ in corpus_pipeline.STAGES][3] == "near_duplicates"


def test_op8_writes_whole_documents_into_their_shards(spark, tmp_path, monkeypatch):
    from hearthscore.llm import queries

    rows = [(i, None if i % 9 == 0 else f"text {i % 40} " * (i % 7), "web") for i in range(200)]
    rows += [(7, "text 7 ", "web"), (None, "no id", None)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"file://{tmp_path}/documents.parquet")
    monkeypatch.setattr(queries, "scratch_path", lambda spark, name: f"file://{tmp_path}/{name}")
    out = queries.op8_sharding(spark, f"file://{tmp_path}")
    stored = spark.read.parquet(f"file://{tmp_path}/shards")
    assert sorted(map(repr, stored.select("doc_id", "text", "source").collect())) == sorted(
        map(repr, spark.createDataFrame(rows, "doc_id long, text string, source string").collect())
    )
    places = out.select("doc_id", "shard", "slot").collect()
    assert sorted(map(repr, places)) == sorted(map(repr, stored.select("doc_id", "shard", "slot").collect()))
    assert len({(r.shard, r.slot) for r in places}) == len(rows)
