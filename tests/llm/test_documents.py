"""The document operators against brute force, on the smallest tables and on odd rows."""

import base64
import hashlib
import re
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from ledgerloom.llm import (  # noqa: E402
    bpe,
    exact_dedup,
    huffman,
    ids,
    language,
    line_templates,
    near_copies,
    packing,
    quality_model,
    quality_rules,
    simhash,
    toxicity,
)
from ledgerloom.llm.components import components  # noqa: E402
from ledgerloom.llm.queries import ORACLES, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, keep_id string, fp double"
LONG = " ".join(f"word{i % 977} and" for i in range(20_000))

# nulls in every column, empty and very long texts, ties, repeated rows, clashing columns
ODD = [
    (1, None, "en", "a", 1, "x", "y", 0.5),
    (2, "", None, None, None, None, None, None),
    (3, "Same Text here  with two  spaces", "en", "a", 1, "x", "y", 0.5),
    (4, "same text HERE  with two  spaces", "en", "a", 1, "x", "y", 0.5),
    (4, "same text HERE  with two  spaces", "en", "a", 1, "x", "y", 0.5),
    (None, "same text here  with two  spaces", "en", "a", 1, "x", "y", 0.5),
    (5, LONG, "de", "b", 1, "x", "y", 0.5),
    (6, " \t\n ", "de", "b", 1, "x", "y", 0.5),
    (7, "Äpfel ÄPFEL äpfel \x01 <|endoftext|> 中文 🙂\r\n", "fr", "b", 1, "x", "y", 0.5),
    (8, "one two", "fr", "b", 1, "x", "y", 0.5),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def texts():
    rows = duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()
    return dict(rows)


def labels_of(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


# exact duplicates


def test_exact_duplicates_match_sql(spark):
    got = QUERIES["op1_exact_dedup"](spark, SF).toPandas().sort_values("doc_id").reset_index(drop=True)
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = duckdb.sql(ORACLES["op1_exact_dedup"]).df().sort_values("doc_id").reset_index(drop=True)
    assert len(got) == len(want)
    assert all((got[c] == want[c]).all() for c in want)


def test_exact_duplicates_chain_colliding_keys(odd, none):
    plain = exact_dedup.exact_duplicates(odd).drop("bucket", "chain").collect()
    few_keys = exact_dedup.exact_duplicates(odd, capacity=1, key_bits=1)
    assert few_keys.agg({"chain": "max"}).first()[0] >= 1
    assert Counter(few_keys.drop("bucket", "chain").collect()) == Counter(plain)
    group = [r for r in plain if r.group_size == 4]
    assert [r.keep_id for r in group] == [4] * 4
    assert sorted((r.doc_id or 0, r.kept) for r in group) == [(0, False), (3, False), (4, True), (4, True)]
    assert {r.keep_id for r in plain if r.doc_id in (1, 2)} == {2}  # null and empty are equal
    assert exact_dedup.exact_duplicates(none).count() == 0
    assert exact_dedup.drop_exact_duplicates(odd).columns == odd.columns


def test_directory_splits_full_buckets():
    counts = {0: 10, 1: 10, 1 << 15: 3}
    slots, depths = exact_dedup.directory(counts, 10)
    held = defaultdict(int)
    for prefix, n in counts.items():
        held[slots[prefix >> (exact_dedup.DEPTH - (len(slots).bit_length() - 1))]] += n
    assert max(held.values()) <= 10 and len(slots) == 1 << max(depths)


# ids and their files


def test_ids_survive_their_files(spark, texts):
    got = QUERIES["op2_huffman_ids"](spark, SF).orderBy("doc_id").collect()
    check_ids(got, list(texts.items()))


def check_ids(got, docs):
    tokenizer, start = Tokenizer.from_file(BYTE_BPE), 0
    assert len(got) == len(docs)
    for row, (doc_id, text) in zip(got, docs, strict=True):
        own = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 0], "<u4")
        assert (row.doc_id, row.start, row.n_tokens) == (doc_id, start, len(own))
        assert row.ids_crc32 == zlib.crc32(own.tobytes())
        start += len(own)


def test_ids_of_odd_rows(odd, none):
    got = huffman.read_ids(*huffman.write_ids(odd, BYTE_BPE, 0)).orderBy("start").collect()
    order = sorted(((r[0], r[1] or "") for r in ODD), key=lambda x: (x[0] is not None, x[0] or 0))
    check_ids(got, order)
    assert huffman.read_ids(*huffman.write_ids(none, BYTE_BPE, 0)).count() == 0


@given(st.lists(st.integers(0, 40), min_size=1, max_size=3000), st.integers(3, 9))
@settings(max_examples=40, deadline=None)
def test_codes_decode_and_keep_their_limit(values, limit):
    found = np.array(values)
    lengths = huffman.code_lengths(np.bincount(found), limit)
    used = lengths[lengths > 0]
    assert used.max() <= max(limit, int(np.ceil(np.log2(max(2, len(used))))))
    assert (2.0**-used).sum() <= 1
    payload, bits = huffman.encode_ids(found, lengths, huffman.canonical_codes(lengths))
    assert huffman.Decoder(lengths).decode(payload, bits, len(found)).tolist() == values


def test_codes_are_as_short_as_huffmans():
    counts = np.array([5, 9, 12, 13, 16, 45])
    assert (huffman.code_lengths(counts) * counts).sum() == 224


@given(st.text(alphabet="ab .,'\n\t\x01\x1c\xa0é1!", max_size=60))
@settings(max_examples=150, deadline=None)
def test_runs_do_not_change_ids(text):
    for path in (BYTE_BPE, WORD_BPE):
        encoder = test_runs_do_not_change_ids.known.setdefault(path, ids.Encoder(path))
        own = encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert encoder.encode([text], 3)[0] == np.array([*own, 3], encoder.width).tobytes()


test_runs_do_not_change_ids.known = {}


def test_special_tokens_are_the_librarys():
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|ENDOFTEXT|>y <|EndOfText|> z", "<|startoftext|>a  \t<|endoftext|>\n", "<|endoftext", "a <| endoftext|>"]
    for path in (BYTE_BPE, WORD_BPE):
        encoder, library = ids.Encoder(path), Tokenizer.from_file(path)
        for text, own in zip(texts, encoder.encode(texts, 3), strict=True):
            assert own == np.array([*library.encode(text, add_special_tokens=False).ids, 3], encoder.width).tobytes(), text
    assert np.frombuffer(ids.Encoder(BYTE_BPE).encode(texts[:1], 0)[0], "<u2").tolist() == [64, 220, 50256, 275, 0]


def test_id_files_are_in_order_of_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(7)
    _, blocks = huffman.write_ids(docs, BYTE_BPE, 0)
    files = blocks.select("start", "doc_ids", F.input_file_name().alias("file")).collect()
    assert len({r.file for r in files}) > 1
    in_files = [i for r in sorted(files, key=lambda r: (r.file, r.start)) for i in r.doc_ids]
    assert in_files == sorted(in_files) and len(in_files) == docs.count()


# packing


def check_pieces(pieces, docs, capacity=packing.CAPACITY):
    tokenizer = Tokenizer.from_file(WORD_BPE)
    own = Counter()
    for doc_id, text in docs:
        data = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 1], "<u4")
        own[(doc_id, len(data), zlib.crc32(data.tobytes()))] += 1
    at = defaultdict(list)
    for p in pieces:
        at[p.sequence_id].append(p)
    assert sorted(at) == list(range(len(at)))
    for row in at.values():
        row.sort(key=lambda p: p.offset)
        ends = np.cumsum([p.length for p in row])
        assert [p.offset for p in row] == [0, *ends[:-1]]
        assert ends[-1] == capacity or ends[-1] & (ends[-1] - 1) == 0
    got = Counter()
    whole = defaultdict(list)
    for p in pieces:
        whole[(p.doc_id, p.doc_tokens)].append(p)
    for (doc_id, n), row in whole.items():
        copies = sum(p.length for p in row) // n
        row.sort(key=lambda p: p.start)
        if copies == 1:
            got[(doc_id, n, zlib.crc32(b"".join(bytes(p.ids) for p in row)))] += 1
        else:  # repeated rows
            got.update({k: v for k, v in own.items() if k[:2] == (doc_id, n)})
    assert got == own


def test_packing_holds_every_id_once(spark, texts, odd, none):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    check_pieces(packing.pack(docs, WORD_BPE, 1, with_ids=True).collect(), list(texts.items()))
    check_pieces(packing.pack(odd, WORD_BPE, 1, capacity=64, window=2, with_ids=True).collect(), [(r[0], r[1] or "") for r in ODD], 64)
    assert packing.pack(none, WORD_BPE, 1).count() == 0


def test_windows_keep_the_mixture(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    pieces = packing.pack(docs, WORD_BPE, 1, window=4).toPandas()
    share = pieces.groupby("queue").length.sum() / pieces.length.sum()
    full = pieces[pieces.window < pieces.window.max() - 1]
    found = full.groupby(["window", "queue"]).length.sum().unstack(fill_value=0)
    assert ((found - share * 4 * packing.CAPACITY).abs() < 2).all().all()
    sums = found.cumsum()  # deficits don't add up
    due = np.outer(sums.index + 1, share[sums.columns]) * 4 * packing.CAPACITY
    assert (np.abs(sums.values - due) < 2).all()


def test_small_sources_are_dealt_over_all_windows(spark):
    rows = [(i, "one two three four", f"s{i // 4}") for i in range(2000)]  # 500 sources, in order of doc_id
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    pieces = packing.pack(docs, WORD_BPE, 1, capacity=128, window=4, max_queues=100).toPandas()
    assert set(pieces["queue"]) == {""} and pieces.length.sum() == len(rows) * pieces.doc_tokens[0]
    spread = pieces.groupby("window").doc_id.agg(lambda x: x.max() - x.min())
    assert (spread[spread.index < spread.index.max()] > 1500).all()


@given(st.lists(st.integers(1, 500), min_size=1, max_size=6), st.lists(st.integers(0, 9), min_size=6, max_size=6))
@settings(max_examples=100, deadline=None)
def test_schedule_grants_every_token(totals, weights):
    schedule = packing.Schedule(totals, weights[: len(totals)], 64)
    rows = [schedule.before(w) for w in range(schedule.n_windows + 1)]
    assert rows[0] == [0] * len(totals) and rows[-1] == totals
    for a, b in zip(rows, rows[1:], strict=False):
        assert all(x <= y for x, y in zip(a, b, strict=True))
    assert all(sum(row) == 64 * w for w, row in enumerate(rows[:-1]))


# byte-level BPE


@pytest.fixture(scope="module")
def tik():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_replay_matches_the_library(spark, texts, tik, odd, none):
    rows = [(r[0], r[1] or "") for r in ODD]
    found = bpe.encode_and_decode(odd, RANKS, public_tokenizers.PATTERN).collect()
    found += QUERIES["op9_merge_replay_bpe"](spark, SF).collect()
    want = Counter()
    for doc_id, text in [*rows, *texts.items()]:
        own = tik.encode_ordinary(text)
        digest = hashlib.sha256(",".join(map(str, own)).encode()).hexdigest()
        want[(doc_id, len(own), digest, hashlib.sha256(text.encode()).hexdigest())] += 1
    assert Counter(map(tuple, found)) == want
    assert bpe.encode_and_decode(none, RANKS, public_tokenizers.PATTERN).count() == 0


def test_replay_of_ranks_that_are_out_of_order():
    # "xyx" comes before "xy", which makes it: the second place of "xy" has to wait
    ranks = {bytes([b]): b for b in range(256)} | {b"xyx": 256, b"xy": 257, b"yx": 258, b"xyxy": 259}
    own = tiktoken.Encoding("own", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
    replay = bpe.MergeReplay(ranks)
    for text in ("xyxy", "xyxyxy", "yxyxyxyx", "xxyyxyxyxx", "xyyxyxyyx" * 5):
        assert bpe.encode_texts(replay, [text], r"[\s\S]+") == [own.encode_ordinary(text)]


# near duplicates


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(values, radius):
    parent = list(range(len(values)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= radius:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(values))]


def test_near_duplicates_match_all_pairs(spark, texts):
    got = QUERIES["op10_simhash_bk_trees"](spark, SF).orderBy("doc_id").collect()
    keys, own = list(texts), [fingerprint(t) for t in texts.values()]
    assert [r.fingerprint for r in got] == [f"{f:016x}" for f in own]
    assert [r.component_id for r in got] == [keys[i] for i in roots(own, 4)]


def test_near_duplicates_of_odd_rows(odd, none):
    got = simhash.near_duplicates(odd).collect()
    assert len(got) == len(ODD)
    assert {r.component_id for r in got if r.fingerprint == "0" * 16} == {1}
    assert {r.doc_id for r in got if r.fingerprint == "0" * 16} == {1, 2, 6}
    assert simhash.near_duplicates(none).count() == 0
    assert sorted(r.doc_id or 0 for r in simhash.drop_near_duplicates(odd).collect()) == [1, 3, 5, 7, 8]


@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=8), st.randoms(use_true_random=False))
@settings(max_examples=60, deadline=None)
def test_trees_lose_no_link(centres, draw):
    values = list({c ^ sum(1 << draw.randrange(64) for _ in range(k)) % 2**64 for c in centres for k in range(6)})
    linked = dict(zip(values, range(len(values)), strict=True))
    parent = list(range(len(values)))
    for a, b in simhash.spanning_links(values, 4):
        x, y = linked[a], linked[b]
        parent = [min(parent[x], parent[y]) if p in (parent[x], parent[y]) else p for p in parent]
    want = roots(values, 4)
    assert [(p == q) for p in parent for q in parent] == [(p == q) for p in want for q in want]


@pytest.mark.parametrize("n", [10, 10**6, 10**9, 10**12])
def test_masks_find_four_changed_bits(n):
    draw, chosen = np.random.default_rng(1), simhash.masks(n, 4)
    for _ in range(300):
        change = sum(1 << int(b) for b in draw.choice(64, 4, replace=False))
        assert any(not change & m for m in chosen)


def test_large_shards_are_dealt(spark):
    draw = np.random.default_rng(5)
    rows = [(int(i), " ".join(f"w{j}" for j in range(60)) + f" x{draw.integers(3)} y{i % 40}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    whole = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()}
    dealt = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs, shard=5).collect()}
    assert whole == dealt


def test_components_of_a_long_path(spark):
    links = spark.range(300).selectExpr("id AS a", "id + 1 AS b").union(spark.range(400, 402).selectExpr("id AS a", "id + 1 AS b"))
    found = {r.node: r.root for r in components(links).collect()}
    assert len(found) == 304 and len({found[i] for i in range(301)}) == 1 and len(set(found.values())) == 2


def test_pipeline_links_near_copies_by_jaccard(spark):
    draw = np.random.default_rng(3)
    base = [[f"w{x}" for x in draw.integers(0, 5000, 200)] for _ in range(40)]
    rows, want = [], []
    for i, words in enumerate(base):
        # a changed word changes five shingles: 196 - 5k of 196 + 5k are shared
        for k, at in ((0, []), (4, [20, 60, 100, 140]), (7, [25, 45, 75, 95, 125, 145, 175])):
            text = " ".join(f"new{i}" if j in at else w for j, w in enumerate(words))
            rows.append((3 * i + (k > 0) + (k > 4), text))
        want += [3 * i, 3 * i + 2]
    rows += [(None, rows[0][1]), (0, rows[0][1]), (200, None), (201, " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    (_, stage) = corpus_pipeline.STAGES[3]
    assert sorted(r.doc_id for r in stage(spark, docs, SF).collect()) == [*want, 200]


def test_near_copies_match_all_pairs(spark):
    draw = np.random.default_rng(4)
    words = [f"w{x}" for x in draw.integers(0, 5000, 120)]
    rows = [(i, " ".join("x" if j in draw.integers(0, 120, 1 + i % 6) else w for j, w in enumerate(words))) for i in range(150)]
    sets = [{tuple(t.split()[i : i + 5]) for i in range(116)} for _, t in rows]
    label = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if 5 * len(a & b) >= 4 * len(a | b) and label[i] != label[j]:
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for piece in (near_copies.PIECE, 500):
        assert sorted(r.doc_id for r in near_copies.near_copies(docs, piece).collect()) == sorted(set(label))


# quality, language, toxicity


def test_quality_on_held_out_documents(spark):
    got = QUERIES["op4_bradley_terry_quality"](spark, "/root/testdata/sf0.01").toPandas()
    known = duckdb.sql("SELECT doc_id, quality FROM '/root/testdata/sf0.01/labels.parquet'").df()
    both = got.merge(known, on="doc_id")
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    assert got.score.between(0, 1).all() and ((got.score >= 0.3) == (got.predicted == 1)).all()
    held = both[both.held_out]
    assert (held.predicted == held.quality).mean() > 0.95


def test_quality_without_labels_keeps_all(spark, odd, none):
    got = quality_model.quality_scores(odd, labels_of(spark)).collect()
    assert len(got) == len(ODD) and {r.predicted for r in got} == {1}
    some = labels_of(spark, [(8, 1, 0), (3, None, None), (7, 1, 1), (7, 0, 1)])
    assert {r.score for r in quality_model.quality_scores(odd, some).collect()} == {0.5}
    assert quality_model.quality_scores(none, some).count() == 0


def test_quality_cut_is_a_quantile():
    rows = np.array([[x, 1.0] for x in range(100)], float)
    model = quality_model.fit(rows, (rows[:, 0] >= 30).astype(float), 0.7)
    assert ((model.score(rows) >= quality_model.CUT) == (rows[:, 0] >= 30)).all()


def test_language_on_held_out_documents(spark):
    got = QUERIES["op5_output_code_language"](spark, "/root/testdata/sf0.01").toPandas()
    known = duckdb.sql("SELECT doc_id, lang FROM '/root/testdata/sf0.01/documents.parquet'").df()
    both = got.merge(known, on="doc_id")
    assert (both.lang == both.lang_pred)[both.held_out].mean() > 0.95


def test_language_of_odd_rows(odd, none):
    got = {r.doc_id: r for r in language.languages(odd).collect()}
    assert {got[i].lang_pred for i in (1, 2, 6)} == {"und"} and got[5].lang_pred in ("en", "de", "fr")
    assert language.languages(none).count() == 0
    unknown = language.languages(odd.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in unknown.collect()} == {"und"}


@pytest.mark.parametrize("n", [2, 3, 4, 6, 9, 40])
def test_codewords_differ(n):
    codes = language.codewords(n)
    apart = [(codes[i] != codes[j]).sum() for i in range(n) for j in range(i)]
    assert min(apart) >= (1 if n == 2 else 2 if n < 7 else 4)


def test_toxicity_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op6_noisy_channel_toxicity"](spark, sf).toPandas()
    known = duckdb.sql(f"SELECT doc_id, toxic FROM '{sf}/labels.parquet'").df()
    both = got.merge(known, on="doc_id")
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id]).all()
    held = both[both.held_out]
    assert (held.predicted == held.toxic).mean() > 0.9


def test_obfuscated_words_are_restored(spark):
    calm = [(i, f"the quiet river of town t{i} runs along the long green valley again") for i in range(200)]
    rude = [(i, f"you are an idiot and the river of town t{i} is stupid") for i in range(200, 300)]
    hidden = ["an 1d10t here", "so i d i o t it is", "st.u.p1d river", "stuuuupid valley", "$tup!d", "IDIOT!!!"]
    tests = [(1000 + i, t) for i, t in enumerate([*hidden, "", None, "the green valley 10 100 a1"])]
    docs = spark.createDataFrame([*calm, *rude, *tests], "doc_id long, text string")
    known = labels_of(spark, [(i, None, 0) for i, _ in calm] + [(i, None, 1) for i, _ in rude])
    got = {r.doc_id: r.predicted for r in toxicity.toxicity_scores(docs, known).collect()}
    assert [got[1000 + i] for i in range(len(tests))] == [1] * len(hidden) + [0, 0, 0]


def test_words_with_doubled_and_edge_letters_are_restored(spark):
    calm = [(i, f"you are an apple and the river of town t{i} is quiet again! (so it seems)") for i in range(200)]
    rude = [(i, f"you are an {('idiot', 'stupid')[i % 2]} and the river of town t{i} is quiet again! (so it seems)") for i in range(200, 300)]
    hidden = ["iidiot", "sstupid", "!diot", "!d!ot", "i d ! o t", "$ t u p ! d", "i  d  i  o  t"]
    clean = ["apple", "appple!", "(apple", "a p p ! e", "| + ! $ |", "a | b + c ! d $ e", "good"]
    texts = [f"you are an {w} and the river of town t is quiet again! (so it seems)" for w in [*hidden, *clean]]
    docs = spark.createDataFrame([*calm, *rude, *enumerate(texts, 1000)], "doc_id long, text string")
    known = labels_of(spark, [(i, None, 0) for i, _ in calm] + [(i, None, 1) for i, _ in rude])
    got = {r.doc_id: r.predicted for r in toxicity.toxicity_scores(docs, known).collect()}
    assert [got[1000 + i] for i in range(len(texts))] == [1] * len(hidden) + [0] * len(clean)


def test_toxicity_without_labels(spark, odd, none):
    assert {r.predicted for r in toxicity.toxicity_scores(odd, labels_of(spark)).collect()} == {0}
    assert toxicity.toxicity_scores(none, labels_of(spark)).count() == 0


# quality rules


def base_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    marked = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 8)}
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(marked), len(lines)


@given(st.lists(st.sampled_from(["a", "b", "a b", "#x", "\n", " ", " ", "é|", "c d e f g h i j"]), max_size=60))
@settings(max_examples=150, deadline=None)
def test_base_counts(parts):
    text = " ".join(parts)
    assert quality_rules.base_counts(text) == base_counts(text)


def test_rules_match_exact_quantiles(spark, texts):
    rows = {r.doc_id: r for r in quality_rules.judged(spark.read.parquet(f"{SF}/documents.parquet")).collect()}
    groups = dict(duckdb.sql(f"SELECT doc_id, (lang, source) FROM '{SF}/documents.parquet'").fetchall())
    counts = {i: dict(zip(("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"), base_counts(t), strict=True)) for i, t in texts.items()}
    failed = {i: c["n_words"] < 20 or 100 * c["n_repeat_words"] > 30 * c["n_words"] for i, c in counts.items()}

    def measure(i, name):
        over, under = quality_rules.MEASURES[name][:2]
        return counts[i][over] / max(counts[i][under], 1)

    def scaled(i, name):
        c = counts[i]
        value = {
            "symbols": lambda: (c["n_symbols"] + 0.5) / (c["n_words"] + 1),
            "dup_lines": lambda: (c["n_dup_lines"] + 0.5) / (c["n_lines"] - c["n_dup_lines"] + 0.5),
            "repeats": lambda: (c["n_repeat_words"] + 0.5) / (c["n_words"] - c["n_repeat_words"] + 0.5),
            "length": lambda: c["word_chars"] / c["n_words"],
        }[name]()
        return (np.floor(np.log(value) / 0.02) + 0.5) * 0.02

    def back(value, name):
        return 1 / (1 + np.exp(-value)) if name in ("dup_lines", "repeats") else np.exp(value)

    def distinct(some):
        return list({(groups[j], texts[j]): j for j in some}.values())

    passed = [i for i in texts if not failed[i]]
    for i in texts:
        same = distinct([j for j in passed if groups[j] == groups[i]])
        if len(same) < quality_rules.ENOUGH:
            if not same:
                assert failed[i]
                continue
            same = distinct([j for j in passed if groups[j][0] == groups[i][0]])
        if len(same) < quality_rules.ENOUGH:
            same = distinct(passed)
        kept = not failed[i]
        for name, (_, _, reach, least) in quality_rules.MEASURES.items():
            values = sorted(scaled(j, name) for j in same)
            low, mid, high = (values[-(-len(values) * part // 20) - 1] for part in (1, 10, 19))
            kept &= measure(i, name) <= back(mid + reach * max(mid - low, least), name)
            if name == "length":
                kept &= measure(i, name) >= back(mid - reach * max(min(mid - low, high - mid), least), name)
        assert rows[i].kept == kept and rows[i].base_failed == failed[i]
        assert tuple(rows[i])[1:6] == base_counts(texts[i])[:5]


def test_limits_follow_their_group(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")  # smaller: few groups of enough texts
    twice = [quality_rules.limits(quality_rules.counted(d)) for d in (docs, docs.repartition(5, "doc_id"))]
    found, again = (sorted(d.collect(), key=lambda r: (r.lang, r.source)) for d in twice)
    assert found == again
    for name in quality_rules.MEASURES:
        assert len({getattr(r, f"{name}_high") for r in found}) > 10


def test_copies_set_no_limit(spark):
    rows = [(i, " ".join(f"w{i:02}x{j:03}" for j in range(20 + 5 * i)), "en", "s") for i in range(60)]
    copies = [(100 + i, rows[7][1], "en", "s") for i in range(500)]
    frames = [spark.createDataFrame(r, "doc_id long, text string, lang string, source string") for r in (rows, rows + copies)]
    a, b = (quality_rules.limits(quality_rules.counted(f)).collect() for f in frames)
    assert a == b
    assert quality_rules.judged(frames[1]).filter("kept").count() == 560


def test_rules_on_odd_rows(odd, none):
    assert quality_rules.judged(odd).count() == len(ODD)
    assert quality_rules.judged(none).count() == 0


# line templates


def test_recurring_lines_are_dropped_after_the_first(spark, none):
    family = [(i, f"intro {i} alone\nPosted by user{i} on the main board today\nUnique words number {i * 37} abc{i}def here") for i in range(6)]
    loose = [(10, "All rights reserved.\nshort one\nText of ten"), (11, "x y z\nAll  rights\treserved.\nshort one"), (12, None), (13, "")]
    again = [(10, "All rights reserved.\nshort one\nText of ten")]
    docs = spark.createDataFrame([*family, *loose, *again], "doc_id long, text string")
    got = [tuple(r) for r in line_templates.drop_recurring_lines(docs).collect()]
    by_id = {r[0]: r for r in got}
    assert by_id[0][2] == 0 and all("Posted by" not in by_id[i][3] for i in range(1, 6))
    assert by_id[10][1:] == (3, 0, loose[0][1]) and sum(r[0] == 10 for r in got) == 2
    assert by_id[11][1:] == (3, 1, "x y z\nshort one")
    assert by_id[12][1:] == (1, 0, "") and by_id[13][1:] == (1, 0, "")
    assert line_templates.drop_recurring_lines(none).count() == 0


def test_every_exact_repeat_is_dropped(spark, texts):
    got = {r.doc_id: r for r in QUERIES["op8_line_templates"](spark, SF).collect()}
    first = {}
    for i, text in texts.items():
        for line in text.split("\n"):
            first.setdefault(" ".join(line.split()), i)
    for i, text in texts.items():
        left = Counter(got[i].text.split("\n") if got[i].n_dropped < got[i].n_lines else [])
        assert not left - Counter(text.split("\n"))
        for line in text.split("\n"):
            words = line.split()
            if len(words) >= line_templates.LEAST and first[" ".join(words)] < i:
                assert line not in left


def test_variable_fields_are_generalised(spark):
    words = ["red", "blue", "green", "white", "black"]
    rows = [(i, f"the price of {w} paint is listed in our catalogue") for i, w in enumerate(words)]
    rows += [(9, "the price of freedom differs wholly from any other thing")]
    got = {r.doc_id: r.n_dropped for r in line_templates.drop_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {0: 0, 1: 1, 2: 1, 3: 1, 4: 1, 9: 0}


def test_templates_do_not_depend_on_the_other_lines_of_a_leaf(spark):
    draw = np.random.default_rng(2)
    rows = [(i, f"the price of c{chr(97 + i // 26)}{chr(97 + i % 26)} paint is listed in our catalogue") for i in range(40)]
    loose = [" ".join("".join(chr(97 + x) for x in draw.integers(0, 26, 8)) for _ in range(7)) for _ in range(400)]
    rows += [(1000 + i, f"the price of {t}") for i, t in enumerate(loose)]
    kinds = ["is set by the board", "was never known to us", "has gone up since then", "may fall again next year", "can not be told here", "will rise with each week"]
    rows += [(2000 + i, f"a report of c{chr(97 + i // 26)}{chr(97 + i % 26)} {kinds[i % 6]}") for i in range(300)]
    got = {r.doc_id: r.n_dropped for r in line_templates.drop_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i] for i in range(40)] == [0] + [1] * 39
    assert not any(got[1000 + i] for i in range(400))
    assert [got[2000 + i] for i in range(300)] == [0] * 6 + [1] * 294


def test_texts_are_parsed_once(spark, tmp_path, monkeypatch):
    """Neither hashed nor split again for each of their lines."""
    rows = [(i, "\n".join(f"the {i % 5} price of line{j % (7 + i)} is known" for j in range(30))) for i in range(20)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents")
    docs, read, write = spark.read.parquet(f"{tmp_path}/documents"), [], line_templates.written

    def watched(df, name):
        read.extend([name] * any(f"{tmp_path}/documents" in file for file in df.inputFiles()))
        return write(df, name)

    monkeypatch.setattr(line_templates, "written", watched)
    found = line_templates.drop_recurring_lines(docs)
    plans = [d._jdf.queryExecution().optimizedPlan().toString() for d in (found, line_templates.parsed(docs))]
    assert read == ["lines"]
    assert "split(" not in "".join(re.findall(r"lambdafunction\([^)]*\)", plans[0])) and "lambdafunction(" in plans[0]
    above = plans[1][: plans[1].index("Generate")]
    assert "xxhash64(text" not in above and above.count("octet_length(replace(own") == 1
    assert found.agg(F.sum("n_dropped")).first()[0] > 0


def test_texts_are_made_even_as_lines_are(spark):
    draw = np.random.default_rng(8)
    texts = ["".join(draw.choice(list("ab  \n\t\r\x0b\f\xa0"), draw.integers(0, 24))) for _ in range(2000)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in rows.select("text", line_templates._even("text").alias("even")).collect():
        assert r.even == "\n".join(re.sub(r"[ \t\x0b\f\r]+", " ", line).strip(" ") for line in r.text.split("\n"))
    few = {(r.doc, r.line_no): r.n for r in line_templates.parsed(rows).collect()}
    want = {(i, j): len(words) for i, t in enumerate(texts) for j, line in enumerate(t.split("\n")) if len(words := re.findall(r"[^ \t\x0b\f\r]+", line)) >= line_templates.LEAST}
    assert few == want and len(want) > 100


# the pipeline


def shingled(text):
    words = lowered(text).split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_pipeline_against_its_parts(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet' ORDER BY doc_id").fetchall()
    good = {r.doc_id for r in quality_model.quality_scores(docs, spark.read.parquet(f"{sf}/labels.parquet")).filter("predicted = 1").collect()}
    kept = {r.doc_id for r in quality_rules.judged(docs.filter(docs.doc_id.isin(list(good)))).filter("kept").collect()}
    last = {}
    for i, text in rows:
        if i in kept:
            last[lowered(text or "")] = i
    left = [(i, shingled(t or "")) for i, t in rows if i in set(last.values())]
    # every pair: near copies share four fifths of their five-word shingles
    root = {i: i for i, _ in left}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, (i, a) in enumerate(left):
        for j, b in left[:k]:
            if 5 * len(a & b) >= 4 * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    firsts = sorted({find(i) for i, _ in left})
    assert len(firsts) < len(left)
    pieces = corpus_pipeline.run(spark, sf).toPandas()
    assert sorted(pieces.doc_id.unique()) == firsts
    assert (pieces.groupby("doc_id").length.sum() == pieces.groupby("doc_id").doc_tokens.max()).all()


def test_stages_keep_columns_of_their_helpers_names(spark):
    draw = np.random.default_rng(12)
    texts = [" ".join(f"w{x}" for x in draw.integers(0, 5000, 60)) for _ in range(6)]
    names = ["_kept_id", "_kept_sha", "_kept_doc_id", "_kept_text_sha", "_kept_lang", "_kept_source", "_sha", "text_sha", "root", "n"]
    schema = "doc_id long, text string, lang string, source string, " + ", ".join(f"{c} string" for c in names) + ", tags map<string,int>"
    rows = [(i, t, "en", "a", *(f"{c}{i}" for c in names), {"x": i}) for i, t in enumerate(texts)]
    rows += [rows[0], rows[1][:4] + rows[2][4:], (9, texts[3].upper(), "en", "a", *names, None)]
    docs = spark.createDataFrame(rows, schema)
    known = labels_of(spark, [(i, i % 2, None) for i in range(6)])
    stages = [exact_dedup.drop_exact_duplicates, near_copies.drop_near_copies, simhash.drop_near_duplicates, quality_rules.drop_by_rules, lambda d: quality_model.drop_low_quality(d, known)]
    for stage in stages:
        out = stage(docs)
        assert out.columns == docs.columns
        found = [tuple(r) for r in out.collect()]
        assert found and all(r in rows for r in found)
        if stage not in stages[3:]:
            assert sorted({r[1].lower() for r in found}) == sorted(texts) and len(found) == 6


def test_sample_is_bounded_whatever_repeats(spark):
    rows = [(1, f"text {i}") for i in range(10_000)] + [(2, "same")] * 500 + [(i, f"other {i}") for i in range(3, 200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame([(1, 1), (2, 0), *((i, i % 2) for i in range(3, 200))], "doc_id long, y int")
    for most in (50, 5000):
        found = quality_model.sample(docs, known, most).collect()
        counts = Counter(r.y for r in found)
        assert max(counts.values()) <= most and len({(r.doc_id, r.text) for r in found}) == len(found)
    assert sum(r.doc_id == 2 for r in found) == 1 and all((r.doc_id, r.text) in set(rows) for r in found)


def test_numbers_are_no_letters():
    for text in ("²", "½ ¾", "Ⅷ", "12 ٣", "_ — 🙂", ""):
        assert not len(language.grams(text))
    assert len(language.grams("é")) and len(language.grams("中"))


def test_near_copies_meet_in_a_bucket():
    """Pairs of a similarity just above four fifths; the bands miss one in twenty million."""
    draw = np.random.default_rng(3)
    missed = 0
    for _ in range(1500):
        a = np.unique(draw.integers(0, 1 << 63, 200, np.uint64))
        b = np.unique(np.concatenate([a[: int(len(a) * 8 / 9) + 1], draw.integers(0, 1 << 63, len(a) - int(len(a) * 8 / 9) - 1, np.uint64)]))
        assert near_copies.alike(a, b)
        missed += not set(near_copies.bands(a)) & set(near_copies.bands(b))
    assert missed == 0


def test_frequent_runs_are_learned_once(monkeypatch):
    """Also where a slice in between does not have them, and too many runs are kept."""
    monkeypatch.setattr(ids, "KEPT_RUNS", 1000)
    encoder, learned = ids.Encoder(BYTE_BPE), Counter()
    learn = encoder._learn_spaced
    monkeypatch.setattr(encoder, "_learn_spaced", lambda new: (learned.update(new := list(new)), learn(new)))
    common = [f"often{chr(97 + i)}" for i in range(20)]
    letters = str.maketrans("0123456789", "abcdefghij")
    slices = [[f"x {f'seldom{i}n{j}'.translate(letters)} " + " ".join(common if i % 3 == 0 else ()) for j in range(256)] for i in range(12)]
    tokenizer = Tokenizer.from_file(BYTE_BPE)
    for texts in slices:
        got = [np.frombuffer(x, encoder.width).tolist() for x in encoder.encode(texts, 0)]
        assert got[::50] == [[*tokenizer.encode(x, add_special_tokens=False).ids, 0] for x in texts[::50]]
        assert len(encoder.spaced) <= 1000 + 300
    assert {learned[run] for run in common} == {1}


def test_a_line_end_makes_no_new_runs(monkeypatch):
    """The last word of a line and the first of the next are learned as runs of their own."""
    encoder, learned = ids.Encoder(BYTE_BPE), Counter()
    learn = encoder._learn_spaced
    monkeypatch.setattr(encoder, "_learn_spaced", lambda new: (learned.update(new := list(new)), learn(new)))
    words = [f"word{chr(97 + i)}" for i in range(20)]
    texts = [f"x {a}.\n{b} y" for a in words for b in words]
    texts += ["a\n\nb", "a \nb", "a\r\nb c", "\na b", "a\n", "a\x1c\nb", "", "a\x01 b\n\x01c", "a\n b", "don't\n's \t\nx"]
    tokenizer = Tokenizer.from_file(BYTE_BPE)
    got = [np.frombuffer(x, encoder.width).tolist() for x in encoder.encode(texts, 0)]
    assert got == [[*tokenizer.encode(x, add_special_tokens=False).ids, 0] for x in texts]
    assert len(learned) <= 2 * len(words) + 20 and set(learned.values()) == {1}
    assert encoder.encode([], 0) == [] and encoder.encode(["a\x01"], 0) != [b""]


def test_ids_are_counted_together(monkeypatch):
    """Room for the vocabulary is not taken for every document."""
    calls, count = [], np.bincount
    monkeypatch.setattr(huffman.np, "bincount", lambda x: (calls.append(1), count(x))[1])
    rows = [np.array([i % 7, 50_000, 0], "<u2") for i in range(1000)]
    columns = [pa.array([x.tobytes() for x in rows], pa.binary()), pa.array([3] * len(rows), pa.int64())]
    (got,) = huffman._count([pa.RecordBatch.from_arrays(columns, ["ids", "n_ids"])])
    found = Counter(i for x in rows for i in x.tolist())
    assert dict(zip(got.column("id").to_pylist(), got.column("n").to_pylist(), strict=True)) == found
    assert len(calls) <= 10


def test_near_copies_lie_within_the_radius():
    """Of the smallest sets too: four shingles of five."""
    draw = np.random.default_rng(5)
    for n, shared in ((5, 4), (10, 8), (45, 40), (200, 178)):
        for _ in range(500):
            a = draw.integers(0, 1 << 63, n, np.uint64) * np.uint64(2)
            b = a[:shared] if n < 40 else np.concatenate([a[:shared], draw.integers(0, 1 << 63, n - shared, np.uint64)])
            assert near_copies.alike(np.unique(a), np.unique(b))
            assert (near_copies.fingerprint(a) ^ near_copies.fingerprint(b)).bit_count() <= near_copies.RADIUS


def test_near_copies_are_found_in_trees(monkeypatch):
    """Only texts within the radius are compared, and nothing that is alike is missed."""
    draw = np.random.default_rng(6)
    base = [draw.integers(0, 1 << 63, 60, np.uint64) for _ in range(30)]
    sets = [np.unique(np.concatenate([x[: 60 - k], draw.integers(0, 1 << 63, k, np.uint64)])) for x in base for k in range(0, 12, 2)]
    shuffled = [sets[i] for i in draw.permutation(len(sets))]
    texts = [near_copies.Text(i, near_copies.fingerprint(x), x) for i, x in enumerate(shuffled)]
    alike, fps, compared = near_copies.alike, {id(t.shingles): t.fp for t in texts}, []

    def watched(a, b):
        compared.append((fps[id(a)] ^ fps[id(b)]).bit_count())
        return alike(a, b)

    monkeypatch.setattr(near_copies, "alike", watched)
    links = near_copies.spanning_links(texts)
    assert compared and max(compared) <= near_copies.RADIUS and len(compared) < len(texts) * (len(texts) - 1) / 4

    def labels(pairs):
        label = list(range(len(texts)))
        for i, j in pairs:
            low, high = sorted((label[i], label[j]))
            label = [low if x == high else x for x in label]
        return label

    every = [(i, j) for j in range(len(texts)) for i in range(j) if alike(texts[i].shingles, texts[j].shingles)]
    assert labels(links) == labels(every) and len(links) == len(texts) - len(set(labels(every)))


def test_stages_judge_rows_whose_ids_repeat(spark):
    draw = np.random.default_rng(8)

    def prose():
        return " ".join(f"w{x}" for x in draw.integers(0, 5000, 60))

    good, other, junk = prose(), prose(), "too short"
    rows = [(None, good), (None, junk), (7, other), (7, junk), (8, other.upper()), (8, other), (8, other), (None, good)]
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.union(docs.filter("doc_id = 8"))
    ruled = quality_rules.drop_by_rules(docs).collect()
    assert len(ruled) == 9 and all(r.text != junk for r in ruled)
    for drop in (exact_dedup.drop_exact_duplicates, simhash.drop_near_duplicates, near_copies.drop_near_copies):
        left = drop(docs.filter("text != 'too short'")).collect()
        assert len(left) == 2 and {r.text.lower() for r in left} == {good, other}, drop
    known = labels_of(spark, [(100 + i, i % 2, None) for i in range(200)])
    texts = [(100 + i, prose() if i % 2 else "$$ buy now !! click here $$ " * 9) for i in range(200)]
    mixed = spark.createDataFrame([*texts, (None, texts[0][1]), (None, texts[1][1]), (101, texts[0][1])], "doc_id long, text string")
    left = quality_model.drop_low_quality(mixed, known).collect()
    assert {r.text for r in left} == {t for i, t in texts if i % 2} and sum(r.doc_id is None for r in left) == 1


def test_pipeline_of_nothing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() == 0, name
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
