"""Token files, line dedup, suffix dedup and decontamination against brute force."""
import hashlib
import json
import re
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyarrow import fs
from tokenizers import Tokenizer

from parcelwise.llm.decontaminate import contamination, drop_contaminated
from parcelwise.llm.line_dedup import CuckooFilter, LineIndex, drop_common_lines, load_index
from parcelwise.llm.suffix_array import common_prefixes, suffix_array
from parcelwise.llm.suffix_dedup import flag_blocks, remove_repeats
from parcelwise.llm.token_frames import FrameReader, WordEncoder, _parts, read_tokens, write_tokens
from parcelwise.llm.words import ALNUM, SPACED, words_of
from parcelwise.session import scratch_path

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


# --- token files ---------------------------------------------------------------------------------
def test_token_files_round_trip(spark, odd, odd_rows):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    manifest = write_tokens(odd, VOCABULARY)
    got = read_tokens(spark, manifest).collect()
    ids = {t: np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [2], "<u4") for t in {r[1] for r in odd_rows}}
    want = Counter((r[0], len(ids[r[1]]), zlib.crc32(ids[r[1]].tobytes()), ids[r[1]].tobytes()) for r in odd_rows)
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32, bytes(r.ids)) for r in got) == want
    rows = sorted(got, key=lambda r: r.start)
    assert [r.start for r in rows] == np.cumsum([0] + [r.n_tokens for r in rows])[:-1].tolist()
    numbers = [-1 if r.doc_id is None else r.doc_id for r in rows]
    assert numbers == sorted(numbers)
    some = read_tokens(spark, manifest, [5, 103, 999]).collect()
    assert sorted(r.doc_id for r in some) == [5, 103]


def test_a_damaged_frame_is_noticed(spark, odd):
    manifest = write_tokens(odd, VOCABULARY)
    system, path = fs.FileSystem.from_uri(manifest[0]["path"])
    with system.open_input_file(path) as f:
        blob = bytearray(f.read())
    blob[20] ^= 255
    with system.open_output_stream(path + ".bad", compression=None) as f:
        f.write(bytes(blob))
    with system.open_input_file(path + ".bad") as f, pytest.raises(Exception):  # noqa: B017, PT011
        list(FrameReader(f).read(np.array([0, 1])))


def test_no_documents_make_no_files(spark, none):
    assert write_tokens(none, VOCABULARY) == []
    assert read_tokens(spark, []).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("aZ9é'’́   \t\n\x0b\x1c\x00<|>日🎉ǅΣς.,-_")), max_size=60))
def test_words_encode_as_the_whole_text_does(text):
    with open(VOCABULARY, encoding="utf-8") as f:
        spec = test_words_encode_as_the_whole_text_does.__dict__.setdefault("spec", f.read())
    both = test_words_encode_as_the_whole_text_does.__dict__.setdefault(
        "both", (WordEncoder(spec, True), WordEncoder(spec, False)))
    for t in (text, text + "<|endoftext|>" + text):
        assert both[0].encode([t.encode()]) == both[1].encode([t.encode()])


@pytest.mark.parametrize("text", ["ALİ.", "YENİ!", "(Bİ),", "ALİ... ALİ", "\u095c.", "\u095e!", "\ufb2a,", "MÜNCHEN. café, Größe!"])
def test_letters_that_normalise_to_marks_before_punctuation(text):
    with open(VOCABULARY, encoding="utf-8") as f:
        spec = f.read()
    assert WordEncoder(spec, True).encode([text.encode()]) == WordEncoder(spec, False).encode([text.encode()])


@pytest.mark.parametrize("text", ["J\u030c", "H\u0331arb ABC", "T\u0308x", "W\u030a!", "Y\u030a", "xJ\u0323\u030c", "J\u030c<|endoftext|>"])
def test_capitals_with_marks_are_composed_before_they_are_lower_cased(text):
    with open(VOCABULARY, encoding="utf-8") as f:
        spec = f.read()
    assert WordEncoder(spec, True).encode([text.encode()]) == WordEncoder(spec, False).encode([text.encode()])


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("abz'ßàöøÿ÷×ÀŸŉªµ \n.,1\u0301\u0308")), max_size=60))
def test_words_of_small_letters_skip_the_normaliser(text):
    with open(VOCABULARY, encoding="utf-8") as f:
        spec = test_words_of_small_letters_skip_the_normaliser.__dict__.setdefault("spec", f.read())
    whole, words = test_words_of_small_letters_skip_the_normaliser.__dict__.setdefault(
        "both", (WordEncoder(spec, False), WordEncoder(spec, True)))
    assert words.letters and not whole.letters
    assert words.encode([text.encode()]) == whole.encode([text.encode()])


def test_other_tokenizer_files_keep_their_normaliser():
    with open(VOCABULARY, encoding="utf-8") as f:
        spec = json.loads(f.read())
    spec["normalizer"]["normalizers"].append({"type": "StripAccents"})
    assert WordEncoder(json.dumps(spec), True).letters is None


def test_a_new_word_does_not_walk_the_word_table():
    """Learning costs as much behind a large table as behind an empty one."""
    with open(VOCABULARY, encoding="utf-8") as f:
        spec = f.read()
    seconds = []
    for held in (0, 600_000):
        encoder = WordEncoder(spec, True)
        encoder.table = {b"#%d" % i: b"" for i in range(held)}
        begun = time.process_time()
        for i in range(300):
            encoder.encode([b"new%dword" % i])
        seconds.append(time.process_time() - begun)
    assert seconds[1] < 4 * seconds[0] + 0.2


def test_words_are_looked_up_once_a_call_and_kept_without_their_punctuation():
    """F1 of round 3 (CPU seconds a GB): Python's work follows a call's distinct words, not all its words."""
    class Counted(dict):
        looked_up = 0

        def __getitem__(self, word):
            Counted.looked_up += 1
            return super().__getitem__(word)

    with open(VOCABULARY, encoding="utf-8") as f:
        spec = f.read()
    encoder = WordEncoder(spec, True)
    encoder.table = Counted()
    texts = [b"Some words, some (more) words.\tWords, MORE words: some!"] * 1_000
    assert encoder.encode(texts) == WordEncoder(spec, False).encode(texts[:1]) * 1_000
    assert Counted.looked_up < 50
    assert set(encoder.table) <= {b"", b"some", b"words", b"more", b"(more", b")", b",", b".", b":", b"!"}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from([b"a", b"Zz", b"9", b"\xc3\x9f", b"\xff", b"\xe6\x97", b" ", b"\n", b"\x1c", b".", b",)", b"'s", b"<|", b"|>",
                                          b"<|endoftext|>", b"<|ENDOFTEXT|>"]), max_size=12).map(b"".join), max_size=8))
def test_texts_of_a_batch_encode_as_each_alone(texts):
    with open(VOCABULARY, encoding="utf-8") as f:
        spec = test_texts_of_a_batch_encode_as_each_alone.__dict__.setdefault("spec", f.read())
    whole, words = test_texts_of_a_batch_encode_as_each_alone.__dict__.setdefault(
        "both", (WordEncoder(spec, False), WordEncoder(spec, True)))
    want = [whole.encode([t])[0] for t in texts]
    assert words.encode(texts) == want
    assert words.encode(pa.array([b"another", *texts], pa.binary()).slice(1)) == want


def test_a_vocabulary_that_lacks_a_letter():
    with open(VOCABULARY, encoding="utf-8") as f:
        spec = json.loads(f.read())
    letter = "q"
    lacks = {t: i for t, i in spec["model"]["vocab"].items() if letter not in t}
    spec["model"]["vocab"] = lacks
    spec["model"]["merges"] = [m for m in spec["model"]["merges"] if all(t in lacks for t in (*m, "".join(m)))]
    texts = [b"iraq quiet ab q, word qqq the iraq. end"]
    assert WordEncoder(json.dumps(spec), True).encode(texts) == WordEncoder(json.dumps(spec), False).encode(texts)


def test_parts_of_a_batch_hold_every_row_once():
    texts = [b"x" * n if n else None for n in (0, 5, 3, 30, 0, 1, 9, 10, 0, 0)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.binary())], ["doc_id", "text"])
    parts = [p.column("text").to_pylist() for p in _parts(batch, 10)]
    assert sum(parts, []) == texts
    assert all(len(p) == 1 or sum(len(t or b"") for t in p) <= 10 for p in parts)
    assert list(_parts(batch.slice(0, 0), 10)) == []


# --- words ---------------------------------------------------------------------------------------
@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("aB9 \t\n\x00é日-.x")), max_size=40), min_size=1, max_size=5))
def test_vectorised_words_equal_a_pattern(texts):
    blobs = [t.encode() for t in texts]
    offsets = np.cumsum([0] + [len(b) for b in blobs])
    data = np.frombuffer(b"".join(blobs), np.uint8)
    for table, pattern in ((SPACED, rb"[^\x20\x09-\x0D]+"), (ALNUM, rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        hashes, at = words_of(data, offsets, table)
        words = [re.findall(pattern, b.lower()) for b in blobs]
        assert np.diff(at).tolist() == [len(w) for w in words]
        flat = [w for x in words for w in x]
        assert len(set(zip(flat, hashes.tolist(), strict=True))) == len(set(flat)) == len(set(hashes.tolist()))


# --- line dedup ----------------------------------------------------------------------------------
SPACE = " \t\n\x0b\x0c\r"


def line_key(line):
    return line.strip(SPACE).encode().lower()


def lines_left(rows, least, counted=None):
    counts = Counter(k for r in (counted or rows) for k in {line_key(x) for x in (r[1] or "").split("\n")} if k)
    out = Counter()
    for r in rows:
        lines = (r[1] or "").split("\n")
        kept = [x for x in lines if counts[line_key(x)] < least]
        out[(r[0], len(lines), len(lines) - len(kept), "\n".join(kept).encode())] += 1
    return out


def dropped(docs, index):
    return Counter((r.doc_id, r.n_lines, r.n_dropped, bytes(r.kept)) for r in drop_common_lines(docs, index).collect())


def test_common_lines_go(odd, odd_rows):
    assert dropped(odd, LineIndex.build(odd, threshold=5)) == lines_left(odd_rows, 5)


def test_index_is_reversible(spark, odd, odd_rows):
    """Insert and delete documents: the index equals one built without them, filters included in their answers."""
    more = odd.where("doc_id % 2 = 0")
    index = LineIndex.build(odd, threshold=5, shards=6)
    grown = index.insert(more)
    twice = odd_rows + [r for r in odd_rows if r[0] is not None and r[0] % 2 == 0]
    assert dropped(odd, grown) == lines_left(odd_rows, 5, twice)
    back = grown.delete(more)
    table = lambda x: sorted(tuple(r) for r in x.table.select("shard", "digests", "counts").collect())
    assert table(back) == table(index)
    assert dropped(odd, back) == lines_left(odd_rows, 5)
    less = index.delete(more)
    assert dropped(odd, less) == lines_left(odd_rows, 5, [r for r in odd_rows if r[0] is None or r[0] % 2])
    path = scratch_path(spark, "saved-index")
    index.table.write.parquet(path)
    assert dropped(odd, load_index(spark, path, 6, 5)) == lines_left(odd_rows, 5)


def test_lines_of_an_empty_table(none):
    index = LineIndex.build(none)
    assert drop_common_lines(none, index).count() == 0


@settings(max_examples=25, deadline=None)
@given(st.sets(st.binary(min_size=16, max_size=16), max_size=120), st.integers(0, 120))
def test_cuckoo_filter_forgets_only_what_is_deleted(digests, cut):
    digests = sorted(digests)
    f = CuckooFilter.of(digests)
    for d in digests[:cut]:
        f.delete(d)
    left = digests[cut:]
    if left:
        assert f.contains(np.frombuffer(b"".join(left), np.uint8).reshape(-1, 16)).all()
    assert (f.table != 0).sum() == len(left)


# --- suffix arrays and repeats ---------------------------------------------------------------------
@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from([1, 97, 98]), min_size=1, max_size=120), st.integers(9, 24))
def test_suffix_array_and_prefixes(values, depth):
    data = np.array(values, np.uint8)
    text = bytes(values)
    sa, rank = suffix_array(data, depth)
    assert sorted(sa.tolist()) == list(range(len(text)))
    assert [text[i:i + depth] for i in sa] == sorted(text[i:i + depth] for i in range(len(text)))

    def share(i, j):
        n = 0
        while n < depth and max(i, j) + n < len(text) and text[i + n] == text[j + n]:
            n += 1
        return n
    want = [0] + [share(int(a), int(b)) for a, b in zip(sa[1:], sa[:-1], strict=True)]
    assert common_prefixes(data, sa, rank, depth).tolist() == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.binary(min_size=12, max_size=40).map(lambda b: bytes(x % 2 + 97 for x in b)), st.integers(1, 2)),
                min_size=1, max_size=8), st.integers(9, 12), st.integers(1, 3))
def test_blocks_find_all_repeats(pieces, length, parts):
    count = Counter()
    for p, n in pieces:
        for i in range(len(p) - length + 1):
            count[p[i:i + length]] += n
    rows = [(0, bytes([i]), n, p) for i, (p, n) in enumerate(pieces)]
    found = dict(flag_blocks([b for b in (rows[i::parts] for i in range(parts)) if b], length))
    for i, (p, _) in enumerate(pieces):
        want = [count[p[j:j + length]] > 1 for j in range(len(p) - length + 1)]
        cover = [any(want[max(0, b - length + 1):b + 1]) for b in range(len(p))]
        got = [False] * len(p)
        for a, b in np.frombuffer(found.get(bytes([i]), b""), "<i4").reshape(-1, 2).tolist():
            got[a:b] = [True] * (b - a)
        assert got == cover


def without_repeats(rows, length):
    texts = [(r[1] or "").encode() for r in rows]
    count = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = Counter()
    for r, t in zip(rows, texts, strict=True):
        cover = np.zeros(len(t) + 1, int)
        for i in range(len(t) - length + 1):
            if count[t[i:i + length]] > 1:
                cover[i:i + length] = 1
        runs = int((np.diff(np.concatenate([[0], cover])) == 1).sum())
        kept = bytes(b for b, c in zip(t, cover, strict=False) if not c)
        out[(r[0], len(t), int(cover.sum()), runs, hashlib.sha256(kept).hexdigest())] += 1
    return out


@pytest.mark.parametrize("length", [60, 200])
def test_repeats_go(odd, odd_rows, length):
    got = remove_repeats(odd, length).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert Counter(tuple(r) for r in got) == without_repeats(odd_rows, length)


def test_repeats_with_small_blocks(odd, odd_rows, monkeypatch):
    """Anchors that fill several blocks are merged across them."""
    import parcelwise.llm.suffix_dedup as module
    monkeypatch.setattr(module, "BLOCK", 700)
    got = remove_repeats(odd, 60).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert Counter(tuple(r) for r in got) == without_repeats(odd_rows, 60)


@pytest.mark.parametrize("length", [60, 200])
def test_repeats_with_hot_anchors(odd, odd_rows, length, monkeypatch):
    """Every anchor with a few different surroundings is taken apart into windows, rare, common or in between."""
    import parcelwise.llm.suffix_dedup as module
    monkeypatch.setattr(module, "HOT", 2)
    monkeypatch.setattr(module, "MANY", 4)
    monkeypatch.setattr(module, "WINDOWS_PER_SHARD", 500)
    got = remove_repeats(odd, length).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert Counter(tuple(r) for r in got) == without_repeats(odd_rows, length)


def test_repeats_of_an_empty_table(none):
    assert remove_repeats(none).count() == 0


# --- decontamination -------------------------------------------------------------------------------
def words(text):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower())


def hits(rows, items, window=10):
    out = Counter()
    for r in rows:
        w, cover, found = words(r[1]), set(), set()
        for name, text in items:
            x = words(text)
            k = min(window, len(x))
            for i in range(len(x) - k + 1 if x else 0):
                for j in range(len(w) - k + 1):
                    if w[j:j + k] == x[i:i + k]:
                        cover |= set(range(j, j + k))
                        found.add("" if name is None else str(name))
        out[(r[0], len(w), len(cover), tuple(sorted(found)))] += 1
    return out


@pytest.fixture
def benchmark_items(odd_rows):
    passage = " ".join(odd_rows[14][1].split("\n")[1].split()[5:40])
    return [(1, passage), (2, "Same... LINE"), (3, None), (4, " ?! "), (None, "aaa bbb"), (12, passage.upper()), (12, "one, TWO"),
            (13, " ".join(passage.split()[:12] + ["zzz"] * 9)), (14, "nowhere to be found in any text at all, ever, so there")]


@pytest.mark.parametrize("block", [1_000_000, 8])
def test_hits_equal_brute_force(spark, odd, odd_rows, benchmark_items, block):
    items = spark.createDataFrame(benchmark_items, "item_id long, text string")
    got = contamination(odd, items, block_words=block).collect()
    assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"] or ())) for r in got) == hits(odd_rows, benchmark_items)


def test_contaminated_rows_go(spark, odd, odd_rows, benchmark_items):
    items = spark.createDataFrame(benchmark_items, "item_id long, text string")
    left = drop_contaminated(odd, items)
    assert left.columns == odd.columns
    want = Counter({k[0]: 0 for k in hits(odd_rows, benchmark_items)})
    for (doc_id, _, n_hit, _), n in hits(odd_rows, benchmark_items).items():
        want[doc_id] += n if n_hit == 0 else 0
    assert Counter(r.doc_id for r in left.collect()) == +want


def test_empty_benchmark_and_empty_table(spark, odd, none, benchmark_items):
    no_items = spark.createDataFrame([], "item_id long, text string")
    assert contamination(odd, no_items).where("n_hit > 0").count() == 0
    assert contamination(none, spark.createDataFrame(benchmark_items, "item_id long, text string")).count() == 0
