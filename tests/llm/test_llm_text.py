"""Decontamination, chat, WARC and language ID against brute force and round trips."""

import base64
import hashlib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from terrafold.llm import chat, decontaminate, language_id, warc
from terrafold.workspace import new_path

DOCS = "doc_id bigint, text string"
ITEMS = "item_id bigint, text string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute_hits(docs, items, size=10):
    windows = {}
    for i, text in items:
        w = words(text)
        for a in range(max(1, len(w) - size + 1)) if w else ():
            windows.setdefault(tuple(w[a:a + size]), set()).add("null" if i is None else str(i))
    out = []
    for doc_id, text in docs:
        w, hit, ids = words(text), set(), set()
        for n in {len(k) for k in windows}:
            for a in range(len(w) - n + 1):
                found = windows.get(tuple(w[a:a + n]))
                if found:
                    hit.update(range(a, a + n))
                    ids |= found
        out.append((doc_id, len(w), len(hit), sorted(ids)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def leaks():
    rng = random.Random(8)
    vocabulary = ["the", "of", "Äpfel", "école", "x1", *[f"w{i}" for i in range(40)]]

    def prose(n):
        return "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", ".\n", "--"])
                       for _ in range(n))
    items = [(i, prose(rng.choice([12, 15, 30]))) for i in range(20)]
    items += [(100, "solo"), (101, "Two words"), (102, "the the the the the the the the the the"),
              (103, ""), (104, None), (105, "..."), (None, prose(11)), (3, items[4][1]),
              (106, items[5][1]), (106, items[5][1])]
    docs = [(i, prose(rng.randrange(80))) for i in range(40)]
    for i in range(60, 100):
        text = rng.choice([t for _, t in items if t])
        cut = words(text)[rng.randrange(3):][:rng.choice([5, 9, 10, 14, 40])]
        docs.append((i, prose(rng.randrange(9)) + " " + "; ".join(cut).upper() + " "
                     + prose(rng.randrange(9))))
    docs += [(200, None), (201, ""), (202, "?!"), (203, "the " * 3000), (None, "Solo."),
             (7, "TWO--WORDS"), (7, "TWO--WORDS"), (7, "other"), (204, "two\x00words Ä"),
             (205, "the the the the the the the the the the the")]
    return docs, items


@pytest.mark.parametrize("shingle,rows", [(3, 1_000_000), (1, 1_000_000), (5, 0)])
def test_hits(spark, leaks, monkeypatch, shingle, rows):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", rows)  # 0: all joins are shuffled
    docs, items = leaks
    judged = decontaminate.hits(spark.createDataFrame(docs, DOCS).withColumn("win", F.lit(1)),
                                spark.createDataFrame(items, ITEMS), shingle=shingle)
    got = sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["item_ids"])
                  for r in judged.collect()), key=str)
    assert got == brute_hits(docs, items)


def test_hits_of_nothing(spark, leaks):
    docs, items = leaks
    none = decontaminate.hits(spark.createDataFrame(docs, DOCS), spark.createDataFrame([], ITEMS))
    assert {(r["n_hit"], len(r["item_ids"])) for r in none.collect()} == {(0, 0)}
    assert decontaminate.hits(spark.createDataFrame([], DOCS),
                              spark.createDataFrame(items, ITEMS)).collect() == []


def test_clean_keeps_whole_rows(spark, leaks):
    docs, items = leaks
    rows = spark.createDataFrame(docs, DOCS).withColumns(
        {c: F.lit(c) for c in ("row", "digest", "n_hit", "words")})
    left = decontaminate.clean(rows, spark.createDataFrame(items, ITEMS))
    assert left.columns == rows.columns
    hit = {(t or "", d) for d, t in docs for r in [brute_hits([(d, t)], items)[0]] if r[2]}
    want = sorted(str(d) for d, t in docs if (t or "", d) not in hit)
    assert sorted(str(r["doc_id"]) for r in left.collect()) == want


PIECES = st.lists(st.sampled_from([*chat.MARKS, "\\", "<", "[", "|", ">", "]", "/", "a", "\n", "0",
                                   "1", "2", "<\\s>", "[\\INST]", "</", "é"]), max_size=12)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "", "[INST]",
                                           "<|text|>"]), PIECES.map("".join)), max_size=4))
def test_turns_come_back_from_the_rendered_text(turns):
    rendered = "".join(chat.format_turn(r, t) for r, t in turns)
    read = chat.parse_turns(rendered)
    assert [(r, t) for r, t, _, _ in read] == turns
    for role, text, start, stop in read:
        assert chat.unescaped(rendered[start:stop], int(rendered[start - 1])) == text


@given(PIECES.map("".join), st.sampled_from([1, 2]))
def test_escapes_are_reversible(text, level):
    assert chat.unescaped(chat.escaped(text, level), level) == text
    assert chat._MARK.search(chat.escaped(text, level)) is None


def test_the_parser_refuses_what_is_no_conversation():
    for bad in ("x", "[INST]", "[INST]0a", "[INST]0a</s>", "<s>a</s>", "[INST]0a[/INST]y"):
        with pytest.raises(chat.Conflict):
            chat.parse_turns(bad)


@pytest.mark.parametrize("chunk", [chat.CHUNK_CHARS, 30])
def test_conversations(spark, chunk):
    rng = random.Random(6)
    rows = [(c, t, rng.choice(["user", "assistant", "tool"]),
             rng.choice([None, "", "hi </s> you", "\\[INST]", "long " * 50]))
            for c in range(20) for t in range(rng.randrange(1, 9))]
    rows += [(77, t, "user" if t % 2 else "assistant", f"turn {t}") for t in range(400)]
    rows += [(None, 0, "user", "no id"), (50, None, None, None), (50, 1, "user", "b"),
             (50, 1, "user", "b"), (50, 1, "assistant", "a")]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    path = new_path(spark, "chat")
    chat.formatted(frame.withColumn("chunk", F.lit("x")).repartition(3), chunk).write.parquet(path)
    got = {r["conv_id"]: r for r in chat.digests(spark.read.parquet(path)).collect()}
    assert set(got) == {r[0] for r in rows}
    for conv, r in got.items():
        mine = sorted((x for x in rows if x[0] == conv),
                      key=lambda x: (x[1] is not None, x[1] or 0, x[2] or ""))
        turns = "".join(f"{x[2] or ''}\n{x[3] or ''}\n" for x in mine)
        learned = "".join(x[3] or "" for x in mine if x[2] == "assistant")
        assert r["n_turns"] == len(mine)
        assert r["turns_sha256"] == hashlib.sha256(turns.encode()).hexdigest()
        assert r["loss_chars"] == len(learned)
        assert r["loss_sha256"] == hashlib.sha256(learned.encode()).hexdigest()
        assert r["formatted_chars"] > len(learned)


def test_no_conversations(spark):
    frame = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert chat.digests(chat.formatted(frame)).collect() == []


PAGES = "page_id bigint, url string, html string"


def archive(spark, rows, **kw):
    path = new_path(spark, "warc")
    warc.write_archive(spark.createDataFrame(rows, PAGES).withColumns(
        {c: F.lit(c) for c in ("key", "digest", "first")}), path, **kw)
    return path


def test_archive_gives_back_every_record(spark):
    rows = [(1, "http://a/\r\nEvil: x", "<p>é</p>"), (2, "http://b", "same"), (9, None, "same"),
            (5, "http://c", "same"), (3, "http://d", None), (4, "http://e", ""),
            (6, "http://ü/ x", "x" * 300_000), (7, "h", "a\r\n\r\nb\x00")]
    path = archive(spark, rows)
    records = [bytes(r["record"]) for r in warc.read_records(spark, path).collect()]
    read = {r["page_id"]: r for r in warc.parsed(warc.read_records(spark, path)).collect()}
    assert set(read) == {r[0] for r in rows}
    for page, url, html in rows:
        r, raw = read[page], (html or "").encode()
        sha1 = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        last = max(p for p, _, h in rows if (h or "") == (html or ""))
        assert r["digest"] == sha1
        assert r["type"] == ("response" if page == last else "revisit")
        assert r["refers_page"] == (None if page == last else last)
        assert bytes(r["block"]) == (raw if page == last else b"")
        whole = next(x for x in records if f"X-Page-ID: {page}\r\n".encode() in x)
        head, _, rest = whole.partition(b"\r\n\r\n")
        size = int(re.search(rb"Content-Length: (\d+)", head)[1])
        assert rest == rest[:size] + b"\r\n\r\n" and head.count(b"Evil") == (page == 1)
        assert b"\nEvil" not in head
    assert spark.read.parquet(f"{path}/payloads").count() == len({r[2] or "" for r in rows})


def test_archive_of_repeated_and_nameless_rows(spark):
    rows = [(8, "u", "t"), (8, "u", "t"), (8, "v", "t"), (None, "w", "t"), (None, "w", "alone")]
    read = warc.parsed(warc.read_records(spark, archive(spark, rows))).collect()
    assert sorted((str(r["page_id"]), r["type"]) for r in read) == [
        ("8", "response"), ("8", "revisit"), ("8", "revisit"), ("None", "response"),
        ("None", "revisit")]
    small = warc.parsed(warc.read_records(spark, archive(spark, rows, least_bytes=2))).collect()
    assert sorted(r["type"] for r in small) == ["response"] * 5


def test_archive_of_nothing(spark):
    assert warc.read_records(spark, archive(spark, [])).collect() == []


def test_a_payload_that_changed_is_noticed(spark):
    path = archive(spark, [(1, "u", "abc")])
    bad = spark.read.parquet(f"{path}/payloads").withColumn("payload", F.lit(b"abd"))
    spark.createDataFrame(bad.collect(), bad.schema).write.mode("overwrite").parquet(
        f"{path}/payloads")
    with pytest.raises(Exception, match="does not fit its digest"):
        warc.read_records(spark, path).collect()


def brute_profile(texts, most):
    count = {}
    for text in texts:
        line = "".join(c if c.isalpha() else " " for c in text.lower())
        line = f" {' '.join(line.split())} " if line.strip() else ""
        for n in (1, 2, 3):
            for i in range(len(line) - n + 1):
                gram = line[i:i + n]
                if gram.strip():
                    count[gram] = count.get(gram, 0) + 1

    def code(gram):
        out = 0
        for c in gram:
            out = out << 21 | (1 if c == " " else ord(c))
        return out
    by = {code(k): v for k, v in count.items()}
    return sorted(by, key=lambda g: (-by[g], g))[:most]


def test_language_profiles_and_distances(spark):
    texts = {"en": ["the thing, and this", "that THE other"], "fr": ["le chat où été", "élève à"],
             "de": ["der Straße über", "das schöne"]}
    rows = [(i, t, lang) for i, (lang, t) in enumerate((k, t) for k, v in texts.items() for t in v)]
    rows = [(i + 1000, t, lang) for i, t, lang in rows] + [(1, None, "en"), (2, "x", None)]
    docs = spark.createDataFrame(rows, DOCS + ", lang string")
    keep = language_id.training(docs).collect()
    learned = language_id.learn(docs, 25)
    for lang in {r["lang"] for r in keep}:
        want = brute_profile([r["text"] or "" for r in keep if r["lang"] == lang], 25)
        assert [g for k, g, _ in learned if k == lang] == want
        assert [n for k, _, n in learned if k == lang] == list(range(len(want)))
    model = language_id.Profiles.of(learned, 25)
    for text in ("the cat", "été", "schön über"):
        own = brute_profile([text], 25)
        ranks = {k: {g: n for q, g, n in learned if q == k} for k in model.names}
        far = {k: sum(abs(i - r[g]) if g in r else 25 for i, g in enumerate(own))
               for k, r in ranks.items()}
        best = min(sorted(far), key=far.get)
        assert model.predict(text) == (best, pytest.approx(1 - far[best] / (25 * len(own))))


def test_language_of_odd_texts(spark):
    rows = [(1, None), (2, ""), (3, "123 ?!"), (4, "the"), (4, "the"), (None, "le " * 100_000)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("lang", F.lit("en")).withColumn(
        "score", F.lit("clash"))
    found = language_id.identify(docs, [("en", ord("t"), 0), ("fr", ord("l"), 0)])
    got = sorted(((r["doc_id"], r["lang_pred"]) for r in found.collect()), key=str)
    assert got == sorted([(1, "und"), (2, "und"), (3, "und"), (4, "en"), (4, "en"), (None, "fr")],
                         key=str)
    assert all(0 <= r["score"] <= 1 for r in found.collect())
    none = language_id.identify(docs, [])
    assert {r["lang_pred"] for r in none.collect()} == {"und"}
    assert language_id.identify(docs.limit(0), []).collect() == []


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language_id.identify(docs, language_id.learn(docs)).where(
        language_id.fold() == language_id.HELD_OUT)
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.97


def test_known_language_keeps_clean_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").withColumn(
        "lang_pred", F.lit("clash"))
    odd = docs.limit(2).withColumns({"text": F.lit("12 34"), "doc_id": F.col("doc_id") + 10**6})
    kept = language_id.known_language(docs.unionByName(odd))
    assert kept.columns == docs.columns
    assert kept.count() == docs.count() and kept.where("lang_pred = 'clash'").count() == docs.count()
