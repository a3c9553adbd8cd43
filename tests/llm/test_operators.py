import hashlib
import random
import re
import zlib

import corpora
import duckdb
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tablework.llm import bpe, chat, contamination, exact, language, toxicity, urls, warc
from tablework.llm.queries import OPERATORS

FOLDER = "/root/testdata/sf0.01"
RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _table(name):
    con = duckdb.connect()
    return con.execute(f"SELECT * FROM '{FOLDER}/{name}.parquet'").fetchdf()


# exact dedup


def _exact(rows):
    norm = [re.sub("[\x20\x09-\x0d]+", " ", t or "") for _, t in rows]
    out = []
    for (d, _), n in zip(rows, norm):
        same = [x for (x, _), m in zip(rows, norm) if m == n]
        known = [x for x in same if x is not None]
        keep = min(known) if known else None
        out.append((d, keep, len(same), d == keep, hashlib.sha256(n.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_exact_groups_of_hard_rows(spark):
    df = corpora.hard(spark)
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert _rows(exact.exact_groups(df)) == _exact(rows)
    assert _rows(exact.exact_groups(corpora.empty(spark))) == []


def test_exact_groups_survive_hash_collisions(spark):
    rows = [(k, "x" * (k % 3) + str(k % 5)) for k in range(40)]
    weak = exact.exact_groups(corpora.frame(spark, rows), content_hash=lambda c: F.length(c).cast("string"))
    assert _rows(weak) == _exact(rows)


def test_drop_copies_keeps_columns(spark):
    df = corpora.hard(spark)
    kept = exact.drop_copies(df)
    assert kept.columns == df.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=repr)
    assert ids == sorted([1, 3, 4, 5, 7, 8, 9, 10, 11, 12, None], key=repr)


def test_drop_copies_where_ids_have_several_texts(spark):
    rows = [(1, "a"), (1, "b"), (2, "a"), (2, "c"), (None, "c"), (None, "d"), (None, "d"), (3, "b  b"), (1, "b b")]
    kept = sorted(((r.doc_id, r.text) for r in exact.drop_copies(corpora.frame(spark, rows)).collect()), key=repr)
    assert kept == sorted([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (1, "b b")], key=repr)


# byte-level BPE


def test_tokens_equal_the_library(spark):
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
    rng = random.Random(1)
    odd = ["".join(rng.choice("ab \n\t1%é中\U0001f600'st\x1c\x85\xa0") for _ in range(rng.choice([3, 40, 900]))) for _ in range(60)]
    rows = [(r.doc_id, r.text) for r in corpora.hard(spark).collect()] + list(enumerate([*odd, "é" * 3000, "ab" * 2000], 100))
    df = corpora.frame(spark, rows)
    want = []
    for d, t in rows:
        ids = encoding.encode_ordinary(t or "")
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        want.append((d, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert _rows(bpe.token_digests(df, RANKS, public_tokenizers.PATTERN)) == sorted(want, key=repr)
    coded = bpe.encode_texts(df, RANKS, public_tokenizers.PATTERN)
    assert [r.ids for r in coded.filter("doc_id = 4").collect()] == [encoding.encode_ordinary("one")]
    back = bpe.decode_ids(coded, RANKS)
    assert back.columns == [*df.columns, "ids", "decoded"]
    assert back.filter("decoded <> encode(coalesce(text, ''), 'UTF-8') OR decoded IS NULL").count() == 0


def test_tokens_of_no_rows(spark):
    assert bpe.token_digests(corpora.empty(spark), RANKS, public_tokenizers.PATTERN).count() == 0


def test_long_words_fold_alike():
    rng = random.Random(2)
    merges = bpe.Merges(RANKS)
    for n in (1, 2, 30, 64):
        word = "".join(rng.choice("abcdetionhr") for _ in range(n)).encode()
        ids = bpe.fold_long(word, RANKS)
        assert merges.fold([word, word]) == [b"".join(i.to_bytes(4, "little") for i in ids)] * 2


# chats


def test_chats_read_back_what_was_written(spark):
    rows = [
        (1, 0, "user", "\\### Assistant: </turn> ok"), (1, 1, "assistant", " </turn>\n### User: \\"), (2, 1, "assistant", "b"),
        (2, 0, "user", None), (3, 0, "od:d = role\\", "x"), (None, None, None, None), (4, 0, "user", "a"), (4, 0, "user", "a"),
        (5, 0, "system", "s"), (5, 1, "user", "#" * 70_000), (5, 2, "assistant", "y <b> " * 20_000),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("segment", F.lit(1)).withColumn("loss", F.lit("x"))
    segments = chat.format_chats(df)
    got = {r.conv_id: r for r in chat.read_chats(segments).collect()}
    for conv in {r[0] for r in rows}:
        turns = sorted(((r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == conv))
        one = got[conv]
        assert one.n_turns == len(turns)
        assert one.turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        assert (one.loss_chars, one.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert {c: r.valid for c, r in got.items()} == {1: True, 2: True, 3: False, None: False, 4: False, 5: True}
    text = "".join(r.text for r in segments.filter("conv_id = 1").orderBy("segment").collect())
    assert chat.Template().read(text) == [("user", rows[0][3]), ("assistant", rows[1][3])]
    assert chat.read_chats(chat.format_chats(df.limit(0))).count() == 0


def test_template_refuses_text_outside_of_turns():
    with pytest.raises(ValueError):
        chat.Template().read("### User: a </turn>\nrest")


# contamination


def _words(text):
    lower = "".join(c.lower() if c < "\x80" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def _contaminated(rows, items, size=13):
    windows = {}
    for i, t in items:
        w = _words(t)
        for k in range(max(1, len(w) - size + 1)) if w else ():
            windows.setdefault(tuple(w[k:k + size]), set()).add(i)
    out = []
    for d, t in rows:
        w, hit, found = _words(t), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if (these := windows.get(tuple(w[k:k + n]))) is not None:
                    hit |= set(range(k, k + n))
                    found |= {str(x) for x in these if x is not None}
        out.append((d, len(w), len(hit), len(found), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def test_contamination_against_brute_force(many_partitions):
    rng = random.Random(9)
    words = [f"v{k}" for k in range(400)]
    items = [(k, " ".join(rng.choices(words, k=rng.choice([1, 3, 6, 13, 30])))) for k in range(40)]
    items += [(7, "a second text of the same item, with quite some more words in it than thirteen"), (90, None), (91, " .,"), (None, items[4][1]), (92, items[4][1])]
    rows = [(r.doc_id, r.text) for r in corpora.hard(many_partitions).collect()]
    for d in range(100, 160):
        body = rng.choices(words, k=rng.choice([0, 5, 80, 400]))
        for _ in range(rng.choice([0, 1, 3])):
            own = (items[rng.randrange(len(items))][1] or "").upper().split()
            at = rng.randrange(len(body) + 1)
            body[at:at] = own if rng.random() < 0.7 else own[:-1]
        rows.append((d, ", ".join(body)))
    bench = many_partitions.createDataFrame(items, "item_id long, text string").withColumn("window", F.lit(1))
    df = corpora.frame(many_partitions, rows).repartition(6)
    got = _rows(contamination.contamination(df, bench))
    assert got == _contaminated(rows, items)
    assert contamination.contamination(corpora.empty(many_partitions), bench).count() == 0
    none = contamination.contamination(df, bench.limit(0))
    assert none.agg(F.sum("n_hit"), F.count("*")).first()[:] == (0, len(rows))


# languages and toxicity


def test_languages_of_held_out_rows(spark):
    got = OPERATORS["op1_language_id"](spark, FOLDER).toPandas().merge(_table("documents")[["doc_id", "lang"]])
    held = got[got.held_out]
    assert (held.lang_pred == held.lang).mean() >= 0.98 and got.score.between(0, 1).all()
    assert (held.doc_id.map(lambda d: zlib.crc32(str(d).encode()) % 4) == 2).all()


def test_languages_of_hard_rows(spark):
    rows = [(k, "the cat and the dog of the house", "en") for k in range(20)] + [(k, "der hund und die katze des hauses", "de") for k in range(20, 35)]
    filters = language.learn_filters(corpora.frame(spark, [*rows, (90, None, "fr"), (91, "12 34", "fr"), (92, "no language", None)]))
    assert filters.languages == ["de", "en"] or filters.languages == ["en", "de"]
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(corpora.hard(spark), filters).collect()}
    assert got[1] == got[2] == got[3] == got[12] == ("und", 0.0)
    assert got[4][0] in filters.languages and 0 <= got[4][1] <= 1
    nothing = language.learn_filters(corpora.empty(spark))
    assert {r.lang_pred for r in language.identify(corpora.hard(spark), nothing).collect()} == {"und"}
    assert language.identify(corpora.empty(spark), filters).count() == 0


def test_filters_hold_every_trigram_of_more_languages_than_a_mask():
    import numpy as np

    text, gram = language.trigrams(["ab c", "", "É9x"])
    assert text.tolist() == [0, 0, 0, 2, 2]
    assert len(set(gram.tolist())) == 5
    masks = np.zeros((1 << 12, 2), np.uint64)
    masks[language.slots(gram[:1], 12, 4).ravel().astype(int), 1] = 1 << 5
    many = language.LanguageFilters([str(k) for k in range(70)], 12, 4, masks, np.zeros(70))
    assert many.languages_of(gram)[0].tolist() == [0, 1 << 5]
    assert many.decide(["a"])[0] == ["0"]


def test_automaton_finds_what_edit_distance_finds():
    def distance(a, b):  # of a to the closest beginning of b
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, last = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        return min(row)

    terms = [toxicity.Term(s, 1.0) for s in ("idiot", "worthless", "scum", "pathetic")]
    automaton = toxicity.Automaton(terms)
    rng = random.Random(4)
    for _ in range(3000):
        word = list(rng.choice(terms).stem)
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(word) + 1)
            word[at:at + rng.randrange(2)] = rng.choice(["", "x", "e", "o"])
        word = "".join(word) + rng.choice(["", "s", "ness"])
        best = min((distance(t.stem, word), k) for k, t in enumerate(terms) if distance(t.stem, word) <= automaton.edits(t.stem)) if any(
            distance(t.stem, word) <= automaton.edits(t.stem) for t in terms) else None
        found = automaton.find(word)
        # an edit before the first letter doesn't count as one
        assert found is None and best is None or found is not None and best is not None and found[0] >= best[0] or (
            best is not None and found is None and word[:1] not in "iwsp"), (word, found, best)


def test_toxicity_of_held_out_rows(spark):
    got = OPERATORS["op8_toxicity"](spark, "/root/testdata/sf0.1").toPandas()
    labels = duckdb.connect().execute("SELECT doc_id, toxic FROM '/root/testdata/sf0.1/labels.parquet'").fetchdf()
    held = got[got.held_out].merge(labels)
    hit = held[(held.predicted == 1) & (held.toxic == 1)]
    assert len(hit) / (held.toxic == 1).sum() > 0.85 and len(hit) / (held.predicted == 1).sum() > 0.85
    assert got.score.between(0, 1).all() and ((got.score >= 0.3) == (got.predicted == 1)).all()


def test_toxicity_of_hard_rows_and_without_labels(spark):
    rows = [(k, f"you are an idiot number {k}") for k in range(0, 120, 2)] + [(k, f"a fine day number {k}") for k in range(1, 120, 2)]
    labels = spark.createDataFrame([(k, 1 - k % 2) for k in range(120)] + [(None, 1), (500, None), (0, 1)], "doc_id long, toxic int")
    docs = corpora.frame(spark, rows)
    model = toxicity.learn(docs, labels)
    assert any("idiot".startswith(t.stem) or t.stem.startswith("idiot") or "you".startswith(t.stem) for t in model.terms)
    scored = toxicity.score_texts(corpora.hard(spark), model)
    assert scored.count() == 15 and scored.filter("score IS NULL OR score < 0 OR score > 1").count() == 0
    spans = toxicity.toxic_spans(docs.filter("doc_id = 2"), toxicity.ToxicityModel((toxicity.Term("idiot", 1.0),), (0.0,) * 5, 0.0))
    assert _rows(spans.select("word", "edits", "at", "quoted")) == [("idiot", 0, 11, False)]
    quoted = corpora.frame(spark, [(1, 'she wrote "what an idiot he is" and left')])
    assert [r.quoted for r in toxicity.toxic_spans(quoted, toxicity.ToxicityModel((toxicity.Term("idiot", 1.0),), (0.0,) * 5, 0.0)).collect()] == [True]
    blank = toxicity.learn(corpora.empty(spark), labels.limit(0))
    assert blank.terms == () and toxicity.score_texts(docs, blank).filter("score > 0.01").count() == 0
    assert toxicity.score_texts(corpora.empty(spark), model).count() == 0


# urls


def _page(k, url, *to):
    return k, url, "".join(f'<a href="{t}">x</a>' for t in to)


def test_rules_and_links(spark):
    rules = [urls.Rule("block", "net", "/"), urls.Rule("allow", "example.net", "/en/"), urls.Rule("block", "example.com", "/de/"),
             urls.Rule("allow", "org", "/fr/")]
    pages = spark.createDataFrame([
        _page(1, "https://A.NET/x", "http://good.org/fr/1"), _page(2, "http://b.example.net/en/1?q=1"), _page(3, "http://b.example.net"),
        _page(4, "x.net/en/"), _page(5, None), _page(6, "http://example.com/de/1#y"), _page(7, "http://xexample.com/de/1"),
        _page(8, "http://linker.com/a", "http://a.net/1", "https://bad.net/2", "/relative"), _page(9, "http://friend.com/", "http://good.org/fr/2"),
        _page(10, "http://good.org/fr/1", "http://friend.com/"), (11, "http://good.org/fr/9", None), _page(11, "http://good.org/fr/9"),
        _page(12, "http://c.com?x://y/"), _page(13, "http://bad.net/"),
    ], "page_id long, url string, html string").withColumn("host", F.lit("clash")).withColumn("rank", F.lit(1))
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge_urls(pages, rules).collect()}
    assert got[1] == ("a.net", "/x", "net/", "block") and got[2] == ("b.example.net", "/en/1", "example.net/en/", "allow")
    assert got[3] == ("b.example.net", "", None, "block") or got[3] == ("b.example.net", "", None, "allow")
    assert got[4] == got[5] == ("", "", None, "allow")
    assert got[6] == ("example.com", "/de/1", "example.com/de/", "block") and got[7][2:] == (None, "allow")
    assert got[8] == ("linker.com", "/a", None, "block") and got[9] == ("friend.com", "/", None, "allow")
    assert got[12][:3] == ("c.com", "", None)
    assert len(urls.judge_urls(pages, rules).collect()) == 14
    assert urls.judge_urls(pages.limit(0), rules).count() == 0


def test_ranks_equal_a_plain_loop(spark):
    rng = random.Random(6)
    hosts = [f"h{k}" for k in range(30)]
    edges = {(a, b) for a in hosts[:25] for b in rng.sample(hosts, 4) if a != b}
    out = {a: sum(x == a for x, _ in edges) for a in hosts}
    seed = {h: rng.random() for h in hosts}
    frame = spark.createDataFrame([(a, b, 1 / out[a]) for a, b in edges], "src string, dst string, share double")
    seeds = spark.createDataFrame(list(seed.items()), "host string, seed double")
    for owner, flow in (("src", frame), ("dst", frame.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "share"))):
        rank = dict(seed)
        for _ in range(7):
            new = {h: 0.15 * seed[h] + (0.85 * rank[h] if not out[h] else 0) for h in hosts}
            for a, b in edges:
                x, y = (a, b) if owner == "src" else (b, a)
                new[y] += 0.85 * rank[x] / out[a]
            rank = new
        got = {r.host: r["rank"] for r in urls.propagate(flow, seeds, owner, rounds=7).collect()}
        assert got.keys() == rank.keys() and all(abs(got[h] - rank[h]) < 1e-9 for h in hosts)


# WARC


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_archives_read_back(spark, tmp_path, compression):
    big = "é<b>" * 800
    rows = [(1, "http://a/1", big), (2, "http://a/2", big), (3, None, None), (4, "http://a/\r\nX: y", "small"), (5, "http://a/5", "small"),
            (None, "http://a/6", big), (2, "http://a/2", big), (7, "http://a/7", "WARC/1.1\r\n\r\n" * 9000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit("clash")).repartition(3)
    path = str(tmp_path / "archives")
    warc.write_archives(warc.page_records(pages), path, compression=compression, fileBytes="2000")
    back = warc.read_archives(spark, path)
    got = [(r.headers.get("X-Page-Id"), r.payload_bytes, r.payload_digest, r.record_type, r.target_uri) for r in back.collect()]
    body = {k: (h or "").encode() for k, _, h in rows}
    assert sorted(got, key=repr) == sorted((
        (None if k is None else str(k), len((h or "").encode()), hashlib.sha1((h or "").encode()).hexdigest(),
         "revisit" if h == big and k != 2 else "response", u and u.replace("\r\n", "%0D%0A")) for k, u, h in rows), key=repr)
    payloads = {r.headers["X-Page-Id"]: bytes(r.payload) for r in back.filter("record_type = 'response'").collect()}
    assert payloads == {str(k): body[k] for k in (2, 3, 4, 5, 7)}
    heads = warc.read_archives(spark, path, payload=False).filter("record_type = 'revisit' AND target_uri = 'http://a/1'")
    assert [(r.payload, r.payload_bytes) for r in heads.collect()] == [(None, len(big.encode()))]
    assert "PushedFilters" in heads._jdf.queryExecution().toString() or heads.count() == 1
    empty = str(tmp_path / "none")
    warc.write_archives(warc.page_records(pages.limit(0)), empty)
    assert warc.read_archives(spark, empty).count() == 0


def test_members_are_plain_gzip():
    import gzip

    record = warc.encode_record({"record_type": "response", "record_id": "<urn:x>", "target_uri": None, "refers_to": None,
                                 "payload_digest": hashlib.sha1(b"ab").hexdigest(), "payload_bytes": 2, "headers": [], "payload": b"ab"})
    packed = warc.member(record)
    assert gzip.decompress(packed + packed) == record * 2 and warc._skip_length(packed) == len(packed)
