"""History index, tokens, mixtures and languages against plain versions."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from siltworks.llm import history, language, mixing, tokens

PATH = tokens.vocabulary_path()


# --- problem 2


def _sig(rng, base=None, change=0):
    s = np.array([rng.getrandbits(32) for _ in range(128)], dtype="<u4") if base is None else base.copy()
    for k in rng.sample(range(128), change):
        s[k] ^= 1 + rng.getrandbits(20)
    return s


def _plain(incoming, hashes, sigs):
    by_hash, near, out = {}, [], set()
    for h, i in hashes:
        by_hash.setdefault(h.lower(), set()).add(i)
    near = [(i, np.frombuffer(s, "<u4")) for i, s in sigs if s is not None and len(s) == 512]
    for i, _, _, h, s in sorted(incoming, key=lambda r: (r[1], r[2])):
        s = np.frombuffer(s, "<u4") if s is not None and len(s) == 512 else None
        hit = {x for x in by_hash.get(h, ()) if x != i} if h else set()
        if s is not None:
            hit |= {j for j, t in near if j != i and (t == s).sum() >= 96}
        out |= {(min(i, x), max(i, x)) for x in hit}
        if not hit:
            if h:
                by_hash.setdefault(h, set()).add(i)
            if s is not None:
                near.append((i, s))
    return out


def _history_case(seed):
    rng = random.Random(seed)
    bases = [_sig(rng) for _ in range(5)]
    hashes = [(f"H{k}", f"c{k:02d}") for k in range(20)]
    sigs = [(f"c{k:02d}", _sig(rng, bases[k % 3], rng.choice([0, 10, 31, 32, 33, 60])).tobytes()) for k in range(12)] + [("c13", None), ("c14", b""), ("c15", b"x" * 480)]
    sigs += sigs[:2]
    incoming = []
    for k in range(80):
        h = rng.choice([f"h{rng.randint(0, 30)}", f"n{rng.randint(0, 12)}", f"n{k}", None])
        s = rng.choice([None, _sig(rng, rng.choice(bases), rng.choice([0, 0, 5, 16, 30, 40])).tobytes()])
        incoming.append((f"i{k:02d}", rng.randint(1, 4), k, h, s))
    incoming += [(i, b + 2, 1000 + q, h, s) for i, b, q, h, s in rng.sample(incoming, 8)]  # delivered again
    return incoming, hashes, sigs


@pytest.fixture
def tables(rows):
    def make(incoming, hashes, sigs):
        return (
            rows("id string, batch_no int, arrival_seq bigint, content_sha256 string, sig binary, content string, key string", [(*r, None, "x") for r in incoming]),
            rows("content_sha256 string, canonical_record_id string", hashes), rows("record_id string, sig binary, sid string", [(*s, "x") for s in sigs]),
        )

    return make


@pytest.mark.parametrize("seed", [1, 2])
def test_history_equals_one_pass(tables, seed):
    case = _history_case(seed)
    got = {tuple(r) for r in history.found(*tables(*case)).collect()}
    assert got == _plain(*case) and len(got) > 20


def test_history_batch_by_batch(spark, tables, tmp_path):
    incoming, hashes, sigs = _history_case(3)
    recs, h, s = tables(incoming, hashes, sigs)
    index = history.PivotIndex(spark, str(tmp_path))
    index.build(h, s)
    got = set()
    for b in (1, 2, 3):
        for _ in range(2 if b == 2 else 1):  # a batch that is run again gives the same
            part = {(min(r), max(r)) for r in index.check(recs.where(f"batch_no = {b}"), b).collect()}
        got |= part
    assert got == _plain([r for r in incoming if r[1] <= 3], hashes, sigs)


def test_blocks_miss_no_near_pair():
    rng = random.Random(0)
    a = _sig(rng)
    for _ in range(100):
        b = _sig(rng, a, 32)
        assert (history.block_distances(a[None])[0] == history.block_distances(b[None])[0]).any()


def test_history_edges(tables):
    recs, h, s = tables([], [], [])
    assert history.found(recs, h, s).count() == 0
    same = [(f"i{k:03d}", 1, k, "h", None) for k in range(200)]
    assert history.found(*tables(same, [], [])).count() == 199


# --- problems 7 and 8


TRICKY = ["", " ", "\n\n", "a", "don't we'll  see\t\tit", "x\x1cy !\x1c!", "12345 ~~~!!", "naïve façade — “q”", "日本語のテキストです。 次", "😀👩‍👩‍👧 ​", "<|endoftext|> a", "a\r\n b\r\n\r\n", "A" * 5000, " " * 3000 + "x" + " " * 3000, "\xa0x　y\x85z", "é" * 700]


@pytest.fixture(scope="module")
def encoder():
    return tokens.Encoder(PATH)


@pytest.fixture(scope="module")
def counter():
    return tokens.Counts(PATH)


def test_encoding_equals_plain_encoding(encoder, counter):
    rng = random.Random(1)
    words = ["alpha", "beta\n", "  gamma", "d-e_f", "9.81", "ζήτα", "漢字", "\t", "'s", "... "]
    texts = TRICKY + ["".join(rng.choice(words) + rng.choice(["", " "]) for _ in range(rng.randint(1, 600))) for _ in range(60)]
    for t in texts * 2:
        want = encoder.encode(t)
        assert encoder(t).tolist() == want and counter(t) == len(want), repr(t[:40])
    assert encoder(None).tolist() == [] and counter(None) == 0


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=400))
def test_encoding_of_any_text(encoder, counter, t):
    want = encoder.encode(t)
    assert encoder(t).tolist() == want and counter(t) == len(want)


def test_ids_table(rows, encoder):
    df = rows("doc_id bigint, text string, ids string", [(1, "a b c", "x"), (2, None, None), (3, "", None), (3, "", None), (4, "x " * 40_000, None)])
    got = sorted((r.doc_id, r.ids) for r in tokens.ids(df).collect())
    assert got[:2] == [(1, encoder.encode("a b c")), (2, [])] and got[2] == got[3] == (3, []) and len(got[4][1]) == len(encoder.encode("x " * 40_000))
    assert tokens.ids(df.limit(0)).count() == 0


def test_budget_adds_up(rows, encoder):
    docs = rows("doc_id bigint, text string, source string, lang string, domain string, kind string", [(1, "a b", "s", "EN", "x", "k"), (2, "c d e", "s", "English", None, "k"), (3, None, None, None, None, None), (4, "f", "t", "und", "x", None)])
    raw = rows("blob_id string, content string, language string, source_shard string", [("b", "int x;", "C", "s-0"), ("b", "int x;", "C", "s-0"), ("c", None, None, None), (None, "y", "c", "s-0")])
    shards = rows("shard_id string, source_dataset string, token_count bigint", [("s-0", "code", 5), ("s-1", "code", None), ("s-2", "other", 0)])
    got = {(r.level, r.kind, r.source, r.language, r.domain): (r.n_texts, r.n_tokens, r.reported) for r in tokens.budget(docs, raw, shards).collect()}
    n = lambda *t: sum(len(encoder.encode(x)) for x in t)
    assert got["domain", "document", "s", "en", "x"] == (1, n("a b"), None) and got["language", "document", "s", "en", None][:2] == (2, n("a b", "c d e"))
    assert got["source", "file", "code", None, None] == (2, n("int x;", "y"), 5) and got["all", None, None, None, None][:2] == (7, n("a b", "c d e", "f", "int x;", "y"))
    by = {r.shard_id: (r.n_tokens, r.reported, r.difference) for r in tokens.by_shard(raw, shards).collect()}
    assert by == {"s-0": (n("int x;", "y"), 5, n("int x;", "y") - 5), "s-1": (0, None, None), "s-2": (0, None, None)}


# --- problem 9


def test_weights_meet_targets_and_limits():
    w, a, b = mixing.weights({"x": 100, "y": 1000, "z": 0}, {"x": 0.5, "y": 0.4, "z": 0.1}, {"x": 2, "y": 1, "z": 9})
    assert a == 1.0 and w["x"] == pytest.approx(5 / 9) and b == pytest.approx(360.0)
    w, a, b = mixing.weights({"x": 100, "y": 1000}, {"x": 0.5, "y": 0.5}, {"x": 2, "y": 1}, budget=1000)
    assert 0 < a < 1 and w["x"] * 1000 == pytest.approx(200, abs=1e-3) and b == 1000
    assert mixing.weights({}, {"x": 1.0}, {}) == ({}, 1.0, 0.0)
    t, x = mixing.temper({"x": 0.9, "y": 0.1}, 0.65)
    assert mixing.entropy(t) == pytest.approx(0.65, abs=1e-6) and 0 < x < 1


def test_mixture_shares(rows):
    rng = random.Random(2)
    data = [(k, " ".join(["word"] * rng.randint(1, 30)), rng.choice(["big"] * 8 + ["mid"] * 3 + ["small"]), 1) for k in range(1500)] + [(9001, None, "big", 1), (9002, "", "mid", 1), (9003, "x", None, 1), (9004, "x", "stranger", 1)]
    docs = rows("doc_id bigint, text string, source string, h int", data)
    targets = rows("source string, target_share double, max_repeats int", [("big", 0.3, 1), ("mid", 0.4, 4), ("small", 0.2, 3), ("gone", 0.1, 2)])
    got = {r.source: r for r in mixing.shares(docs, targets).collect()}
    for s, t in (("big", 1 / 3), ("mid", 4 / 9), ("small", 2 / 9)):
        assert got[s].actual_share == pytest.approx(t, abs=0.002) and got[s].most_copies <= got[s].max_repeats
    assert got["gone"].tokens == 0 and got["gone"].actual_share == 0
    m = mixing.mixture(docs, targets).collect()
    assert len({r.doc_id for r in m}) == len(m) and not {r.doc_id for r in m} & {9001, 9002, 9003, 9004}
    assert mixing.mixture(docs.limit(0), targets).count() == 0 and mixing.shares(docs, targets.limit(0)).count() == 0


# --- problem 10


TEXTS = {
    "en": "The parser keeps the oldest checkpoints before the next commit. Every worker merges the rows that were written. You can turn this off with a flag. The queue drops the files when memory runs short.",
    "de": "Der Planer behält die ältesten Sicherungspunkte vor dem nächsten Abgleich. Jeder Prozess sammelt die Zeilen, die geschrieben wurden. Das Werkzeug öffnet die Dateien nach einem Neustart noch einmal.",
    "fr": "Le planificateur conserve les anciens points de contrôle avant la prochaine validation. Chaque processus fusionne les lignes écrites. La passerelle rejette les fichiers abîmés quand la mémoire manque.",
    "es": "El planificador conserva los puntos de control antiguos antes de la próxima confirmación. Cada proceso combina las filas escritas. La pasarela descarta los archivos dañados cuando falta memoria.",
    "ru": "Планировщик сохраняет старые контрольные точки перед следующей фиксацией. Каждый процесс объединяет строки.",
    "ja": "解析器は次の確定の前に古い保存点を検証します。作業は受信した記録を統合します。",
    "zh": "调度器在下一次提交之前保留旧的检查点。每个进程合并收到的记录。",
}


def test_language_of_documents(rows):
    data = [(k * 10 + j, " ".join([t] * 3), lang) for j in range(8) for k, (lang, t) in enumerate(TEXTS.items())]
    data += [(900, TEXTS["de"], "en"), (901, TEXTS["fr"], None), (902, TEXTS["en"] + "\n\n" + TEXTS["es"], "en"), (903, "```\ncode here is not prose.\n```\nx = 1", None), (904, None, None), (905, "", ""), (906, TEXTS["zh"], "zh-CN"), (907, TEXTS["ja"], "unknown"), (908, TEXTS["de"], "German")]
    df = rows("doc_id bigint, text string, lang string, label string, h int", [(*d, None, 1) for d in data])
    got = {tuple(r) for r in language.found(df).where("doc_id >= 900").collect()}
    assert got == {(900, "de"), (901, "fr"), (902, "en"), (902, "es"), (907, "ja")}
    assert language.found(df.where("doc_id < 900")).count() == 0 and language.found(df.limit(0)).count() == 0


def test_prose_and_labels():
    assert language.sentences("## Head\n- One two three.\n$ run it now.\nno end here\n`x` 5.") == ["One two three."]
    assert [language.label_of(x) for x in ("en_US", "German", " ", "und", "pt-BR", "sv", None)] == ["en", "de", None, None, "pt", "sv", None]


def test_quotes_are_prose(rows):
    body, quoted = TEXTS["en"], "\n".join("> " + s + "." for s in TEXTS["de"].rstrip(".").split(". "))
    assert language.sentences("> One two three.\n>> Four five six.\n > > - Seven eight nine.") == ["One two three.", "Four five six.", "Seven eight nine."]
    assert language.sentences("> $ run it now.\n>     indented by four blanks.\n> x = one two three.\n    > Indented by four.") == []
    data = [(k * 10 + j, " ".join([t] * 3), lang) for j in range(8) for k, (lang, t) in enumerate(TEXTS.items())]
    data += [(900, f"{body}\n\n{quoted}", "en"), (901, quoted, "en"), (902, quoted, "de")]
    got = {tuple(r) for r in language.found(rows("doc_id bigint, text string, lang string", data)).where("doc_id >= 900").collect()}
    assert got == {(900, "en"), (900, "de"), (901, "de")}


def test_every_language_is_encoded():
    dicts = {
        "de": "abgebrochene Verbindungsaufbauten\nfehlgeschlagene Zertifikatspruefungen\nzwei Sicherungspunkten\nam fruehen Vormittag\nohne jede Benachrichtigung\nnach langem Stillstand",
        "en": "Anna Miller likes the very long title of a rather old handbook\nCarlos Miller", "fr": "Anna Miller et les autres\nCarlos Miller arrive", "es": "el archivo de la cola",
    }
    c = language.Classifier({k: v.encode() for k, v in dicts.items()})
    # names that two dictionaries hold, and words that the right one holds in another form
    assert c.classify("Anna Miller Verbindungsaufbau Zertifikatspruefung Sicherungspunkt.")[0] == "de"
    # far behind after the longest clause, ahead after all
    text = "likes the very long title of a rather old handbook, am fruehen Vormittag, ohne jede Benachrichtigung, nach langem Stillstand, zwei Sicherungspunkten."
    size = {k: sum(len(z.compress(p.encode())) for p in language.clauses(text)) for k, z in c.by.items()}
    first, second = sorted(size, key=lambda k: (size[k], k))[:2]
    assert c.classify(text)[0] == first == "de" and size[second] - size[first] >= language.MARGIN


def test_many_sentences_at_once_equal_one_at_a_time():
    c = language.Classifier({k: v.encode() for k, v in TEXTS.items()})
    texts = [s for t in TEXTS.values() for s in language.sentences(t)] + ["Пример: see the file, пожалуйста подождите немного здесь.", "これは test です、そして終わりました。", "x y z.", "!!! ???"]
    together = c.classify_all(texts)
    assert together == [language.Classifier({k: v.encode() for k, v in TEXTS.items()}).classify(s) for s in texts]
    assert {got for got, _ in together[:2]} == {"en"} and all(0 <= p <= 1 for _, p in together)
    # a script that one language has alone is decided by sizes too, and by itself where its language has no dictionary
    ru = language.sentences(TEXTS["ru"])[0]
    assert c.classify(ru)[0] == "ru" and language.Classifier({"en": b"the quick brown fox", "de": b"der schnelle Fuchs"}).classify(ru) == ("ru", 1.0)
    small = language.Classifier({k: v.encode() for k, v in TEXTS.items()}, keep=1)  # forgets after every batch
    for _ in range(2):
        small.learn(texts)
        assert [small.memo[t] for t in texts[:4]] == together[:4]


def test_sentences_are_cut_at_ends():
    assert language.split_sentences('One. Two! "Three?" (Four.) five. Six… Ünd. ünd') == ["One.", "Two!", '"Three?', "(Four.) five.", "Six…", "Ünd. ünd"]
    assert language.split_sentences("一。二！」三") == ["一。", "二！", "三"] and language.split_sentences("") == [""]


def test_limits_and_entropy_move_the_exponent(rows):
    rng = random.Random(6)
    docs = rows("doc_id bigint, text string, source string", [(k, " ".join(["word"] * rng.randint(1, 9)), "big" if k % 10 else "small") for k in range(2000)])
    targets = rows("source string, target_share double, max_repeats int", [("big", 0.5, 1), ("small", 0.5, 2)])
    got = {r.source: r for r in mixing.shares(docs, targets, passes=1.0).collect()}
    assert 0 < got["small"].exponent < 1 and got["small"].most_copies == 2
    # all of the small source twice, and the rest of the budget from the big one
    assert got["small"].actual_share == pytest.approx(got["small"].weight, abs=0.01) and got["small"].actual_share == pytest.approx(0.2, abs=0.03)
    got = {r.source: r for r in mixing.shares(docs, targets, evenness=0.5).collect()}
    assert mixing.entropy({k: r.weight for k, r in got.items()}) == pytest.approx(0.5, abs=1e-4) and got["small"].actual_share == pytest.approx(got["small"].weight, abs=0.01)
    even = {r.source: r for r in mixing.shares(docs, targets, evenness="targets").collect()}
    assert even["big"].exponent < 0.01 and even["big"].weight == pytest.approx(0.5, abs=0.01)
    assert {r.tokens for r in mixing.shares(docs.limit(0), targets, evenness="targets").collect()} == {0}


def test_counts_are_weighted_by_frequency(counter, monkeypatch):
    seen = []
    c = tokens.Counts(PATH)
    texts = ["one two two", "two  one", None, "", "zz one"]
    want = {("a",): [3, counter(texts[0]) + counter(texts[1])], ("b",): [2, counter("zz one")]}
    monkeypatch.setattr(tokens, "surviving", lambda p, r, f=tokens.surviving: seen.append(p) or f(p, r))
    assert c.totals([("a",), ("a",), ("a",), ("b",), ("b",)], texts) == want
    assert len(seen) == len(set(seen)) + 1  # "one" with and without a blank before it; each word once


def test_chunks_without_blanks_are_reused():
    rng = random.Random(8)
    shared = "".join(rng.choice("語彙表記録検索統合保存点次確定前古受信、。「」1２a-") for _ in range(3000))
    e = tokens.Encoder(PATH)
    one, two = "前置き。" + shared, "別の文書、" + shared + "終わり"
    assert e(one).tolist() == e.encode(one) and e.insides
    before = len(e.insides)
    assert e(two).tolist() == e.encode(two) and len(e.insides) - before <= 3  # only around the different ends
    tiny = tokens.Encoder(PATH, keep=1)  # forgets before every text
    assert tiny(two).tolist() == e.encode(two) and tiny(one).tolist() == e.encode(one)
    for text in ("'" * 400 + "re" * 300, " \n" * 900 + "x", "語" * 5000, "don't " * 300, "a\n\n" * 500, "\r\n\r\n  b" * 200):
        assert e(text).tolist() == e.encode(text)
