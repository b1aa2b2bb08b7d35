"""Edge cases and brute-force versions of the text operators."""

import hashlib
import io
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagloom.llm import chat, decontaminate, language, minhash, mixing, ppm, quality, suffix, token_counts, token_output
from tagloom.llm.components import components
from tagloom.llm.seekable import Reader, Writer

WORDS = "the of and to in is that it for on was with be as at alpha beta gamma delta epsilon zeta eta theta iota kappa".split()


def text(seed, n, words=WORDS):
    rng = np.random.default_rng(seed)
    return " ".join(words[i] + str(rng.integers(0, 40)) for i in rng.integers(0, len(words), n))


def docs(spark, rows, **more):
    """rows: (doc_id, text, lang, source); extra columns with names that operators use themselves."""
    d = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    return d.withColumn("n_chars", F.length("text")).withColumns({k: F.lit(v) for k, v in {"key": "x", "position": 7, "rank": 1, "kept": True, "bands": 3, "block": 5, "id": 9, **more}.items()})


ODD = [(1, None, None, None), (2, "", "en", "a"), (3, " \n\t ", "en", None), (None, "some text here", None, "a"), (4, "word", "en", "a"), (4, "word", "en", "a"), (5, "x " * 30000, "en", "b"), (-6, "é ß 日本語 😀 ½", None, "b"), (7, text(1, 300), "en", "a"), (8, text(1, 300), "de", "b")]


@pytest.fixture(scope="module")
def odd(spark):
    return docs(spark, ODD)


def empty(d):
    return d.where("false")


# --- quality ---


def plain_quality(t):
    words = (t or "").encode().split()
    words = [w.decode() for w in words]
    wins = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if wins[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in (t or "").split("\n") if x.encode().split()]
    return len(words), sum(map(len, words)), sum((t or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_quality_counts(spark, odd):
    got = [tuple(r[1:]) for r in quality.judge(odd).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()]
    assert Counter(got) == Counter(plain_quality(t) for _, t, _, _ in ODD)
    more = [(i, t, "en", "a") for i, t in enumerate(["a b c d e f g h i " * 3 + "z", "a\nb\na\n\n \na", "x#|<> y", "1 2 3 4 5 6 7 8 1 2 3 4 5 6 7 8 9"])]
    got = quality.judge(docs(spark, more)).orderBy("doc_id").select("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()
    assert [tuple(r) for r in got] == [plain_quality(t) for _, t, _, _ in more]
    assert quality.judge(empty(odd)).count() == 0


def test_accepted_keeps_columns_and_good_rows(spark):
    good = "The river of the town is in the valley and it was quiet on that day for the people with boats. " * 1 + text(3, 40)
    d = docs(spark, [(1, good, "en", "a"), (2, "bad bad", "en", "a"), (3, None, "en", "a")])
    out = quality.accepted(d)
    assert out.columns == d.columns and [r.doc_id for r in out.collect()] == [1]


# --- near duplicates ---


def plain_components(rows, percent):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(d, least.get(find(i), d))
    return sorted((d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows))


def edited(t, seed, n):
    w, rng = t.split(), np.random.default_rng(seed)
    for i in rng.integers(0, len(w), n):
        w[i] = f"edit{rng.integers(0, 10**6)}"
    return " ".join(w)


def test_near_duplicates_against_all_pairs(spark):
    """A star (copies near the base, not near one another), a chain, exact copies and short texts."""
    base, rows = text(10, 400), []
    rows += [(100 + i, edited(base, i, 5)) for i in range(30)] + [(99, base)]
    chain = text(20, 300)
    for i in range(8):
        rows.append((200 - i, chain))
        chain = edited(chain, 50 + i, 3)
    rows += [(300, "a b c"), (301, "A  b\nc"), (302, "a b"), (303, ""), (304, None), (305, text(1, 200)), (306, text(1, 200))]
    d = spark.createDataFrame(rows, "doc_id bigint, text string")
    for percent in (85, 80):
        got = minhash.near_duplicates(spark, d, percent=percent, tile=8).collect()
        assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == plain_components(rows, percent)
        assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_recall_of_pairs_near_the_threshold(spark):
    """Pairs of single links, most of them close above 85 %: all that share enough are joined."""
    rows = []
    for i in range(500):
        base = text(5000 + i, 200)
        rows += [(2 * i, base), (2 * i + 1, edited(base, 9000 + i, 2 + i % 3))]
    d = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark, d, percent=85).collect()}
    want = {a: c for a, _, c in (x for i in range(500) for x in plain_components(rows[2 * i : 2 * i + 2], 85))}
    assert got == want and 200 < sum(a != c for a, c in want.items()) < 480


def test_near_duplicates_odd_rows(spark, odd):
    got = minhash.near_duplicates(spark, odd).collect()
    assert len(got) == len(ODD)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert by[8][0].component_id == 7 and by[1][0].kept and by[1][0].n_shingles == 0 and [r.component_id for r in by[4]] == [4, 4]
    assert by[None][0].component_id is None and by[None][0].kept is None
    assert minhash.near_duplicates(spark, empty(odd)).count() == 0


def test_components(spark):
    links = [(i, i + 1) for i in range(50, 80)] + [(100, 1), (1, 100), (7, 7)] + [(500, 500 + i) for i in range(1, 40)]
    got = {r.node: r.component for r in components(spark, spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {**{i: 50 for i in range(50, 81)}, 1: 1, 100: 1, **{500 + i: 500 for i in range(40)}}


# --- repeats ---


def plain_removal(rows, length):
    count = Counter(b[i : i + length] for b in rows for i in range(len(b) - length + 1))
    out = []
    for b in rows:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if count[b[i : i + length]] > 1:
                gone[i : i + length] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((len(b), int(gone.sum()), spans, bytes(np.frombuffer(b, np.uint8)[~gone])))
    return Counter(out)


@pytest.mark.parametrize("shard_rows,many", [(4000, 8192), (4000, 2), (2, 3)])
def test_repeats_against_counting(spark, shard_rows, many, monkeypatch):
    """One shard, many shards of a collection, and collections split down to single starts."""
    shared, plain, build = text(5, 90), suffix.repeated_spans, suffix.build_shards
    monkeypatch.setattr(suffix, "repeated_spans", lambda s, d, n: plain(s, d, n, shard_rows))
    monkeypatch.setattr(suffix, "build_shards", lambda r, n: build(r, n, many))
    rows = [text(100 + i, 60) + shared[i : 300 + 3 * i] + text(200 + i, 50) for i in range(12)]
    rows += ["ab" * 300, "abc " * 200, shared[:199], shared[:200], shared[10:210] + shared[10:210], "", None, "é" * 150, rows[0], rows[0]]
    d = docs(spark, [(i % 5 or None, t, None, None) for i, t in enumerate(rows)])
    got = suffix.remove_repeats(spark, d, 200).collect()
    made = Counter((r.n_bytes, sum(r.spans[1::2]) - sum(r.spans[::2]), len(r.spans) // 2, bytes(r.left)) for r in got)
    assert made == plain_removal([(t or "").encode() for t in rows], 200)


def test_merged_transforms_are_the_transform_of_all():
    """Random strings of few letters, dealt to shards: the merge finds what comparing all windows finds."""
    rng = np.random.default_rng(4)
    for case in range(40):
        length, rows = 5, []
        for k in range(int(rng.integers(2, 14))):
            off, n = int(rng.integers(0, 4)), int(rng.integers(1, 7))
            off = min(off, n + length - 2)
            rows.append((0, k, off, n, bytes(rng.choice(list(b"ab"), n + length - 1).tolist())))
        cuts = sorted({0, len(rows), *rng.integers(0, len(rows), 3).tolist()})
        shards = []
        for a, b in zip(cuts, cuts[1:], strict=False):
            symbols, right = suffix._symbols(rows[a:b], length)
            shards.append((case, suffix.transform(symbols, np.zeros(b - a, np.int64)), right))
        far = max(r[2] for r in rows) + 1
        got = suffix.merge(shards, np.arange(len(rows)), length, far)
        for i, (_, _, off, n, body) in enumerate(rows):
            for j in range(min(far, off + 1)):
                if off - j < n:
                    window = body[off - j : off - j + length]
                    assert got[i, j] == any(o - j >= 0 and x[o - j : o - j + length] == window for k, (_, _, o, _, x) in enumerate(rows) if k != i)


def test_repeats_odd_rows(spark, odd):
    assert suffix.remove_repeats(spark, odd).count() == len(ODD) and suffix.remove_repeats(spark, empty(odd)).count() == 0


def test_long_texts_are_cut_in_overlapping_pieces():
    t = text(3, 5000).encode()
    starts = [s + i for s, p in suffix._segments(t, 200, 1000) for i in range(len(p) - 199)]
    assert starts == list(range(len(t) - 199))


# --- token files ---


def test_token_files_round_trip(spark, odd):
    from tokenizers import Tokenizer

    folder = None
    t = Tokenizer.from_file(token_output.tokenizer_path())
    want = [np.array([*t.encode(x or "", add_special_tokens=False).ids, 2], "<u4").tobytes() for _, x, _, _ in sorted(ODD, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))]
    got = sorted(token_output.token_output(spark, odd, folder=folder).collect(), key=lambda r: r.start)
    assert [r.n_tokens for r in got] == [len(w) // 4 for w in want] and [r.ids_crc32 for r in got] == [zlib.crc32(w) for w in want]
    assert [r.start for r in got] == [sum(len(w) // 4 for w in want[:i]) for i in range(len(want))]
    assert [r.doc_id for r in got] == [None, -6, 1, 2, 3, 4, 4, 5, 7, 8]
    assert token_output.token_output(spark, empty(odd)).count() == 0


def test_token_files_of_one_id_with_many_texts(spark, tmp_path):
    """Equal ids come in the order of their texts' hashes over all files; what a lost task left is removed."""
    rows = [(5, text(i, 20), None, None) for i in range(300)] + [(6, "x", None, None)]
    folder = f"file://{tmp_path}/out"
    (tmp_path / "out").mkdir()
    (tmp_path / "out" / ".000001-lost").write_bytes(b"part of a file")
    manifest = token_output.write_tokens(spark, docs(spark, rows), folder, token_output.tokenizer_path(), 2)
    paths = [r.path.removeprefix("file://") for r in sorted(manifest.collect())]
    assert len(paths) > 1 and not [p for p in (tmp_path / "out").iterdir() if p.name.startswith(".") and not p.name.endswith(".crc")]
    got = [bytes(x) for p in paths for _, x in Reader(io.BytesIO(open(p, "rb").read()), len(open(p, "rb").read())).documents()]
    hashes = {r.text: r.h for r in docs(spark, rows).select("text", F.xxhash64("text").alias("h")).collect()}
    e = token_output.WordEncoder(token_output.tokenizer_path())
    want = [e.encode([t.encode()])[0] + np.array([2], "<u4").tobytes() for t in [*sorted((t for i, t, *_ in rows if i == 5), key=lambda t: (hashes[t], t)), "x"]]
    assert got == want


def test_tokenizers_of_other_forms_encode_whole_texts(spark):
    from tokenizers import Tokenizer

    path = token_output.tokenizer_path("byte_bpe_50k.json")
    assert token_output.by_words(token_output.tokenizer_path()) and not token_output.by_words(path)
    t, rows = Tokenizer.from_file(path), [(i, x, None, None) for i, x in enumerate(["Two  words", " x\n\ny ", "don't STOP", "", None])]
    got = sorted(token_output.token_output(spark, docs(spark, rows), path).collect())
    assert [r.ids_crc32 for r in got] == [zlib.crc32(np.array([*t.encode(x or "", add_special_tokens=False).ids, 2], "<u4").tobytes()) for _, x, _, _ in rows]


def test_seekable_file_reads_only_what_is_asked():
    out = io.BytesIO()
    w = Writer(out, frame_bytes=400)
    data = {i: np.arange(i % 30, dtype="<u4").tobytes() for i in range(0, 600, 3)}
    for i, x in data.items():
        w.add(i, x)
    w.close()
    raw = out.getvalue()
    assert w.n_bytes == len(raw) and w.n_docs == len(data)
    r = Reader(io.BytesIO(raw), len(raw))
    assert dict(r.documents()) == data and len(r.table) > 10
    assert r.find(303) == [data[303]] and r.find(304) == [] and len(r.frames_of(303)) <= 2
    broken = bytearray(raw)
    broken[int(r.offsets[3]) + 20] ^= 1
    bad = Reader(io.BytesIO(bytes(broken)), len(raw))
    with pytest.raises(ValueError):
        list(bad.documents())
    assert bad.find(0) == [data[0]]  # other frames are still readable


def test_word_encoder_is_the_tokenizer():
    from tokenizers import Tokenizer

    t, e = Tokenizer.from_file(token_output.tokenizer_path()), token_output.WordEncoder(token_output.tokenizer_path(), 50, 50)
    for x in ("İstanbul ΣΑΣ don't we'LL <|endoftext|>x á ́b é\x1cq\x85z ﬁ ½ 𝟜 日本 12345 !!??'s ǅ ß ẞ naïve­soft", text(1, 200), "", " \t\n"):
        assert np.frombuffer(e.encode([x.encode()])[0], "<u4").tolist() == t.encode(x, add_special_tokens=False).ids


# --- token counts ---


def test_token_counts_are_greedy(spark, odd):
    pieces = [bytes([b]) for b in range(256)] + [b" a", b" ab", b"abc", b"bc", b"bcd", b" abcde", b"cd", b"dede"]
    machine, known = token_counts.Automaton(pieces), set(pieces)

    def greedy(w):
        n = 0
        while w:
            k = next(k for k in range(len(w), 0, -1) if w[:k] in known)
            w, n = w[k:], n + 1
        return n

    rng = np.random.default_rng(0)
    for _ in range(500):
        w = b" " + bytes(rng.choice(list(b"abcde"), rng.integers(0, 12)).tolist())
        assert machine.count(w) == greedy(w)
    assert token_counts.Automaton([b"a", b"ab"]).count(b"abc") == 1  # no segmentation: the unknown piece
    got = token_counts.token_counts(odd, token_output.tokenizer_path("byte_bpe_50k.json")).collect()
    assert len(got) == len(ODD) and {r.n_tokens for r in got if r.n_words == 0} == {0}
    assert token_counts.token_counts(empty(odd), token_output.tokenizer_path("byte_bpe_50k.json")).count() == 0


# --- language models ---


def test_kneser_ney_sums_to_one():
    m = language.Models({"x": language.LanguageModel(["abab", "abc", "cab"], [3, 2, 1])})
    for stem in ("", "a", "ab", "zz"):  # q stands for all characters never seen
        assert sum(_next(m, stem, c) for c in [*"abcq", None]) == pytest.approx(1, abs=1e-5)
    word = m.log_probs(["abc"])[0]
    assert word[0] == pytest.approx(sum(np.log(_next(m, "abc"[:i], c)) for i, c in enumerate([*"abc", None])), rel=1e-5) and word[1] == 4


def _next(m, stem, c):
    """Probability of the next character (None: the end) after a stem, from the difference of two prefixes' scores."""
    codes, predicted, _ = language._codes([stem + (c or "")])
    at = np.flatnonzero(predicted)[len(stem)]
    h = language.gram_hashes(codes)
    p = m.base.copy()
    for k in range(1, language.ORDER + 1):
        for cells, values, f in (
            (*m._entries(m.backs[k - 1], h[k - 2][[at - 1]] if k > 1 else np.zeros(1, np.uint64)), np.multiply),
            (*m._entries(m.grams[k - 1], h[k - 1][[at]]), np.add),
        ):
            p[cells] = f(p[cells], values)
    return float(p[0])


def plain_kneser_ney(counts, order):
    """Log probability of a word, by the definition: dictionaries of grams and of what comes before them."""
    levels = {order: Counter()}
    for word, n in counts.items():
        seq = ["<"] * (order - 1) + list(word) + [">"]
        for i in range(order - 1, len(seq)):
            levels[order][tuple(seq[i - order + 1 : i + 1])] += n
    for m in range(order - 1, 0, -1):
        levels[m] = Counter(g[1:] for g in levels[m + 1])
    discount = {}
    for m, grams in levels.items():
        n1, n2 = sum(c == 1 for c in grams.values()), sum(c == 2 for c in grams.values())
        discount[m] = n1 / (n1 + 2 * n2) if n1 and n2 else 0.75

    def p(context, c, m):
        if m == 0:
            return 1 / (len(levels[1]) + 1)
        after = {g: n for g, n in levels[m].items() if g[:-1] == context[len(context) - m + 1 :]}
        low = p(context, c, m - 1)
        if not after:
            return low
        total, d = sum(after.values()), discount[m]
        return max(after.get((*context[len(context) - m + 1 :], c), 0) - d, 0) / total + d * len(after) / total * low

    def score(word):
        seq = ["<"] * (order - 1) + list(word) + [">"]
        return sum(np.log(p(tuple(seq[i - order + 1 : i]), seq[i], order)) for i in range(order - 1, len(seq)))

    return score


def test_kneser_ney_against_its_definition():
    """Three languages side by side, worked on in small and large batches."""
    rng = np.random.default_rng(6)
    langs = {k: Counter("".join(rng.choice(list(a), rng.integers(1, 8))) for _ in range(60)) for k, a in {"x": "abc", "y": "bcde", "z": "éab"}.items()}
    models = language.Models({k: language.LanguageModel(list(c), list(c.values())) for k, c in langs.items()})
    words = ["", "a", "abcab", "bcde", "éa", "zzz", "aaaaaaaaaa", *list(langs["y"])[:20]]
    plain = [plain_kneser_ney(langs[k], language.ORDER) for k in models.langs]
    for models.CELLS in (10, 1 << 22):
        got = models.log_probs(words)
        for i, w in enumerate(words):
            assert got[i, -1] == (len(w) + 1 if w else 0)
            assert got[i, :-1] == pytest.approx([f(w) if w else 0 for f in plain], rel=1e-4)


def test_no_language_is_left_out(spark):
    """More languages than there are characters for, of very unequal sizes, and a very long text."""
    rows = [(i, " ".join(chr(0x4E00 + i % 200) * 3 + chr(0x4E00 + i % 200 + k) for k in range(8)), f"l{i % 200}", "s") for i in range(600)]
    rows.append((1000, "lang " * 300_000, "long", "s"))
    models = language.fit(spark, docs(spark, rows), F.lit(True), altogether=201 * 400)
    assert len(models.langs) == 201
    got = {r.doc_id: r.lang_pred for r in language.identify(spark, docs(spark, rows), models).collect()}
    assert np.mean([got[i] == rows[i][2] for i in range(600)]) > 0.95


def test_language_of_held_out_texts(spark, odd):
    rows = []
    for i in range(300):
        lang = ("aa", "bb")[i % 2]
        rows.append((i, " ".join("".join(np.random.default_rng(i * 100 + k).choice(list("abcde" if lang == "aa" else "cdefg"), 6)) for k in range(15)), lang, "s"))
    d = docs(spark, rows)
    models = language.fit(spark, d, F.col("doc_id") < 200, per_language=8000)
    got = {r.doc_id: r for r in language.identify(spark, d, models).collect()}
    assert np.mean([got[i].lang_pred == rows[i][2] for i in range(200, 300)]) > 0.97
    assert all(0 <= r.score <= 1 for r in got.values())
    for r in language.identify(spark, odd, models).collect():
        assert (r.lang_pred == "und") == (r.doc_id in (1, 2, 3))
    assert language.fit(spark, empty(d), F.lit(True)) is None
    assert {r.lang_pred for r in language.identify(spark, odd, None).collect()} == {"und"}


# --- PPM ---


def plain_ppm(train, t, order):
    """Dictionaries of contexts, coded byte by byte with escapes and exclusion."""
    edge, table = ppm.EDGE, {}
    for x in train:
        s = [edge] * order + list(x) + [edge]
        for i in range(order, len(s)):
            for j in range(order + 1):
                table.setdefault(tuple(s[i - j : i]), Counter())[s[i]] += 1
    s, total = [edge] * order + list(t) + [edge], 0.0
    for i in range(order, len(s)):
        out, p = set(), 1.0
        for j in range(order, -1, -1):
            seen = {k: v for k, v in table.get(tuple(s[i - j : i]), {}).items() if k not in out}
            n, d = sum(seen.values()), len(seen)
            if s[i] in seen:
                p *= seen[s[i]] / (n + d)
                break
            if d:
                p *= d / (n + d)
                out |= set(seen)
        else:
            p /= 256 - len(out)
        total += np.log10(p)
    return total


def test_ppm_against_dictionaries(spark):
    rows = [(i, x, None, None) for i, x in enumerate([text(i, 30) for i in range(8)] + ["", None, "Größe ÉTÉ", "the the the", "zzz\x00"])]
    d = docs(spark, rows)
    train = [(x or "").encode() for i, x, _, _ in rows if i % 3]
    words = Counter(w for x in train for w in [*x.lower().split(), None])
    n, v = sum(words.values()), len(words)
    scored = ppm.score(spark, d, F.col("doc_id") % 3 != 0).collect()
    many = ppm.score(spark, d, F.col("doc_id") % 3 != 0, block_bytes=40, width=2).collect()  # sums of sums of sums
    assert sorted(map(tuple, many)) == sorted(map(tuple, scored)) and len(scored) == len(rows)
    for r in scored:
        b = (rows[r.doc_id][1] or "").encode()
        tokens = [*b.lower().split(), None]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (len(tokens), sum(w in words for w in tokens), n, r.doc_id % 3 == 0)
        assert r.base_score == pytest.approx(sum(np.log10((words[w] + 1) / (n + v + 1)) for w in tokens))
        assert r.score == pytest.approx(plain_ppm(train, b, ppm.ORDER), rel=1e-5)


def test_ppm_odd_rows(spark, odd):
    assert ppm.score(spark, odd, F.col("doc_id") % 2 == 0).count() == len(ODD)
    assert ppm.score(spark, empty(odd), F.lit(True)).count() == 0
    r = ppm.score(spark, odd, F.lit(None).cast("boolean")).where("doc_id = 2").first()
    assert r.train_tokens == 0 and r.score == pytest.approx(np.log10(1 / 256))


# --- mixing ---


@pytest.mark.parametrize("n", [[1], [1, 1], [5, 3, 2], [7, 1, 1, 1], [60, 25, 10, 4, 1], [3, 3, 3]])
def test_schedule_is_fair(spark, n):
    slots = mixing.schedule(spark, n).orderBy("slot").collect()
    d, have = sum(n), [0] * len(n)
    assert [r.slot for r in slots] == list(range(d))
    for t, r in enumerate(slots):
        assert r.before == have and r.block_no == have[r.source_no]
        have[r.source_no] += 1
        assert all(abs(have[i] - (t + 1) * n[i] / d) < 1 for i in range(len(n)))
    assert have == n


def test_mixing_places_every_row(spark, odd):
    rows = [(i, str(i), None, "abc"[min(i % 7, 2)]) for i in range(500)] + [(i, None, None, None) for i in range(20)]
    out = mixing.mix(spark, docs(spark, rows), {"a": 1, "b": 1, "c": 2, None: 1}, block_rows=4).collect()
    assert sorted(r.position for r in out) == list(range(520))
    order = sorted(out, key=lambda r: r.position)
    assert [r.slot for r in order] == sorted(r.slot for r in out)
    first = Counter(r.source for r in order[:80])
    assert abs(first["c"] - 32) <= 4 and abs(first["a"] - 16) <= 4 and abs(first[None] - 16) <= 4
    assert mixing.mix(spark, odd).count() == len(ODD)
    e = mixing.mix(spark, empty(odd))
    assert e.count() == 0 and "position" in e.columns


@pytest.mark.parametrize("weights", [{"a": 1, "b": 2, "c": 3, "d": 7}, {"a": 0.1, "b": 0.2, "c": 0.37, "d": 0.33}, {"a": 5, "b": 1, "c": 0, "e": 9}])
def test_every_prefix_keeps_to_the_weights(spark, odd, weights):
    """Less than one block from the weights themselves after every slot of many periods, until a source runs out."""
    rows = [(i, str(i), None, "abcd"[i % 4]) for i in range(8000)] + [(i, "z", None, "none") for i in range(9)]
    out = sorted(mixing.mix(spark, docs(spark, rows), weights, block_rows=2).collect(), key=lambda r: r.position)
    assert [r.position for r in out] == list(range(8009)) and [r.slot for r in out] == sorted(r.slot for r in out)
    have, total, sizes = Counter(), sum(weights.get(s, 0) for s in "abcd"), Counter(r.source for r in out)
    for t, r in enumerate(out, 1):
        have[r.source] += 1
        if t % 2 == 0:
            assert r.slot == t // 2 - 1
            assert all(abs(have[s] / 2 - t / 2 * weights.get(s, 0) / total) < 1 for s in "abcd")
        if have[r.source] == sizes[r.source]:
            break
    assert t > 2390  # where the first source runs out
    last = [s for s in (*"abcd", "none") if not weights.get(s, 0)]
    assert {r.source for r in out[-sum(sizes[s] for s in last) :]} == set(last)


def test_mixing_many_sources_and_clashing_names(spark):
    rows = [(i, str(i), None, f"s{i % 1500}") for i in range(6000)]
    d = docs(spark, rows).withColumns({"_rank": F.lit("r"), "_o": F.lit("o"), "slot": F.lit("mine")})
    out = mixing.mix(spark, d, block_rows=2, added=("w", "x", "y", "z")).collect()
    assert sorted(r.z for r in out) == list(range(6000)) and {(r["_rank"], r["_o"], r["slot"], r.block) for r in out} == {("r", "o", "mine", 5)}
    assert mixing.whole_weights([0.1, 0.2, 3]) == [1, 2, 30] and mixing.whole_weights([50] * 3) == [1] * 3


def test_mixing_a_very_long_text(spark):
    rows = [(1, "long " * 2_000_000, None, "a"), *((i, str(i), None, "b") for i in range(2, 40))]
    out = mixing.mix(spark, docs(spark, rows)).select("doc_id", "position", F.length("text").alias("n")).collect()
    assert sorted(r.position for r in out) == list(range(39)) and max(r.n for r in out) == 10_000_000


# --- chat ---


def test_preference_pairs(spark):
    rows = [
        (1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (2, 0, "user", "hi"), (2, 1, "assistant", "no"), (2, 2, "user", "why"), (3, 0, "user", "bye"),
        (4, 1, "assistant", None), (4, 0, None, "sys"), (None, 0, "user", "lost"),
    ]
    d = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("rank", F.lit(1))
    got = {frozenset(x for x in (r.chosen_id, r.rejected_id) if x): r for r in chat.preference_pairs(d).collect()}
    assert set(got) == {frozenset((1, 2)), frozenset((3,)), frozenset((4,))}
    p = got[frozenset((1, 2))]
    assert p.n_common == 1 and p.prompt == "<|user|>\nhi<|end|>\n"
    for c, spans in ((p.chosen, p.chosen_spans), (p.rejected, p.rejected_spans)):
        assert [c[a:b] for a, b in spans] in (["yes<|end|>\n"], ["no<|end|>\n"])
    assert got[frozenset((3,))].rejected is None and got[frozenset((4,))].chosen == "<||>\nsys<|end|>\n<|assistant|>\n<|end|>\n"
    assert chat.preference_pairs(d.where("false")).count() == 0


def test_identical_conversations_share_everything(spark):
    d = spark.createDataFrame([(i, t, "user", str(t)) for i in range(4) for t in range(3)], "conv_id bigint, turn bigint, role string, text string")
    got = chat.preference_pairs(d).collect()
    assert len(got) == 2 and all((r.n_common, r.chosen, r.rejected) == (3, "", "") for r in got)


def test_every_conversation_gets_a_rejected_reply(spark):
    rows = [(i, t, ("user", "assistant")[t % 2], f"{('ask', 'say')[t % 2]} {i if t < 3 or i > 2 else 0}") for i in range(7) for t in range(4)]
    rows += [(5, 4, "user", "more"), (50, 0, "user", "no reply"), (51, 0, "assistant", "alone")]
    d = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("rank", F.lit(1))
    got = {r.chosen_id: r for r in chat.reply_pairs(spark, d).collect()}
    assert sorted(got) == [*range(7), 50, 51] and got[50].rejected is None and got[50].chosen_spans == []
    text = {(c, t): x for c, t, _, x in rows}
    for i in range(7):  # 0, 1 and 2 end with the same reply
        r = got[i]
        other = r.rejected.split("<|end|>")[0].removeprefix("<|assistant|>\n")
        assert r.n_common == 3 and r.prompt.count("<|end|>") == 3 and f"say {i}" in r.prompt and r.chosen != r.rejected
        assert other == ("alone" if r.rejected_id == 51 else text[r.rejected_id, 3]) and r.rejected_id not in (1, 2)
        assert r.chosen == f"<|assistant|>\n{text[i, 3]}<|end|>\n" + ("<|user|>\nmore<|end|>\n" if i == 5 else "")
        assert [r.rejected[a:b] for a, b in r.rejected_spans] == [f"{other}<|end|>\n"]
    assert got[51].n_common == 0 and got[51].rejected
    assert [r.rejected for r in chat.reply_pairs(spark, d.where("conv_id < 3 and turn > 2")).collect()] == [None] * 3
    assert chat.reply_pairs(spark, d.where("false")).count() == 0


def test_a_very_long_conversation(spark):
    rows = [(i, t, ("user", "assistant")[t % 2], f"turn {t}" if t < 3999 else f"end {i}") for i in range(2) for t in range(4000)]
    d = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = sorted(chat.reply_pairs(spark, d).collect(), key=lambda r: r.chosen_id)
    assert [(r.n_common, r.chosen, r.rejected) for r in got] == [(3999, f"<|assistant|>\nend {i}<|end|>\n", f"<|assistant|>\nend {1 - i}<|end|>\n") for i in range(2)]


# --- decontamination ---


def test_lcs():
    def plain(a, b):
        m = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                m[i + 1][j + 1] = m[i][j] + 1 if x == y else max(m[i][j + 1], m[i + 1][j])
        return m[-1][-1]

    rng = np.random.default_rng(1)
    for _ in range(100):
        a, b = (rng.choice(list("abcd"), rng.integers(0, 15)).tolist() for _ in range(2))
        assert decontaminate.lcs(a, b) == plain(a, b)


def test_short_items_have_to_be_there_word_for_word():
    s, body = decontaminate.Settings(), [b"a", b"b", b"x", b"c", b"d", b"e"]
    assert decontaminate.check_pair([b"c", b"d", b"e"], body, s) == 1 and decontaminate.check_pair([b"b", b"c", b"d"], body, s) == 0


def test_leaks(spark, odd):
    vocabulary = [f"w{i}" for i in range(3000)]
    make = lambda seed, n: " ".join(np.random.default_rng(seed).choice(vocabulary, n))
    items = [(i, make(i, 30)) for i in range(20)] + [(50, ""), (51, None), (None, "x y z")]
    rows, want = [], {}
    for i in range(120):
        body = make(1000 + i, 200).split()
        if i % 4 == 0:
            item = items[i % 20][1].split()
            if i % 8 == 0:  # reworded: every sixth word replaced, upper case, marks between words
                item = [w if k % 6 else f"new{k}" for k, w in enumerate(item)]
                item = " ".join(item).upper().replace(" W", ", W").split()
            body[60:60] = item
            want[i] = [i % 20]
        rows.append((i, " ".join(body), None, None))
    rows += [(500 + i, items[3][1], None, None) for i in range(60)]
    want |= {500 + i: [3] for i in range(60)}
    b = spark.createDataFrame(items, "item_id bigint, text string").withColumn("doc_id", F.lit(1))
    got = {r.doc_id: r["items"] for r in decontaminate.find_leaks(spark, docs(spark, rows), b).collect() if r.leaked}
    assert got == want
    small = decontaminate.Settings(block_items=7)
    assert {r.doc_id: r["items"] for r in decontaminate.find_leaks(spark, docs(spark, rows), b, small).collect() if r.leaked} == want
    assert decontaminate.find_leaks(spark, odd, b).where("leaked").count() == 0
    assert decontaminate.find_leaks(spark, odd, b).count() == len(ODD)
    assert decontaminate.find_leaks(spark, odd, b.where("false")).count() == len(ODD)
    assert decontaminate.find_leaks(spark, empty(odd), b).count() == 0


def test_recall_of_reworded_items_against_exhaustive_search(spark):
    """Items reworded to different degrees, over a vocabulary with common and rare words: of all pairs of a document and
    an item that the longest common subsequence confirms, at least nine of ten are found, and no other is reported."""
    rng, s = np.random.default_rng(8), decontaminate.Settings()
    vocabulary, p = np.array([f"w{i}" for i in range(4000)]), 1 / np.arange(3, 4003)
    make = lambda n: rng.choice(vocabulary, n, p=p / p.sum()).tolist()
    items = [make(int(rng.integers(3, 80))) for _ in range(300)] + [make(400), make(1500)]
    rows = []
    for i in range(900):
        body = make(int(rng.integers(20, 400)))
        if i % 3 == 0:
            item = list(items[(i // 3) % len(items)])
            for k in np.flatnonzero(rng.random(len(item)) < rng.choice([0, 0.1, 0.2, 0.3, 0.38])):
                item[k] = str(rng.choice(vocabulary))
            at = int(rng.integers(0, len(body)))
            body[at:at] = item
        rows.append((i, " ".join(body), None, None))
    bodies, encoded = [t.encode().split() for _, t, _, _ in rows], [[w.encode() for w in x] for x in items]
    true = set()
    for i, body in enumerate(bodies):
        have = Counter(body)
        for k, item in enumerate(encoded):
            if sum((Counter(item) & have).values()) >= min(s.reworded, 1) * len(item) and decontaminate.check_pair(item, body, s):
                true.add((i, k))
    b = spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(items)], "item_id bigint, text string")
    got = {(r.doc_id, k) for r in decontaminate.find_leaks(spark, docs(spark, rows), b).collect() for k in r["items"]}
    print("recall", len(got & true) / len(true), "of", len(true), "others", len(got - true))
    assert len(true) > 150 and len(got & true) >= 0.9 * len(true)
    assert len(got - true) <= 0.02 * len(got)  # stretches may start at other places than the exhaustive search's


def test_items_that_are_there_word_for_word_are_found(spark):
    """All pairs of items of 1 to 19 words, cut from documents, that brute force finds; a block of 4000 items."""
    rng, vocabulary = np.random.default_rng(3), [f"w{i}" for i in range(2500)]
    rows = [(i, " ".join(rng.choice(vocabulary, 150)), None, None) for i in range(400)]
    items = []
    for i in range(4000):
        w, n = rows[i % 400][1].split(), 2 + i % 18
        at = int(rng.integers(0, 150 - n))
        items.append((i, " ".join(w[at : at + n])))
    items += [(4000, "w7"), (4001, "zz w8"), (4002, "zz yy xx")]
    b = spark.createDataFrame(items, "item_id bigint, text string")
    got = {r.doc_id: set(r["items"]) for r in decontaminate.find_leaks(spark, docs(spark, rows), b, decontaminate.Settings(block_items=5000)).collect()}
    padded = [f" {t} " for _, t, _, _ in rows]
    assert sum(len(x) for x in got.values()) > 4000
    for d, t in enumerate(padded):
        assert {i for i, x in items if f" {x} " in t} <= got[d]
        assert all(f" {items[i][1]} " in t for i in got[d] if len(items[i][1].split()) < 8)
