"""Exact dedup, mixing, fingerprints, pieces and archives against brute force."""

import gzip
import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sft_tables.llm import exact_dedup, fingerprints, mixing, pieces, warc

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.mark.parametrize("keep, best", [("smallest", min), ("largest", max)])
def test_exact_groups(docs, keep, best):
    rng = random.Random(3)
    texts = ["One two", "ONE two", "É", "é", "", None, "tail "] + ["hot"] * 5
    rows = [(i, rng.choice(texts)) for i in range(200)]
    norm = {i: (t or "").translate(ASCII) for i, t in rows}
    groups = {}
    for i, t in norm.items():
        groups.setdefault(t, []).append(i)
    found = {r["doc_id"]: r for r in exact_dedup.exact_groups(docs(rows).repartition(5), keep).collect()}
    for i, t in norm.items():
        r = found[i]
        assert (r["keep_id"], r["group_size"], r["kept"]) == (best(groups[t]), len(groups[t]), i == best(groups[t]))
        assert r["text_sha256"] == hashlib.sha256(t.encode()).hexdigest()
    left = exact_dedup.drop_exact_copies(docs(rows).repartition(5), keep).collect()
    assert sorted((r["doc_id"], r["text"]) for r in left) == sorted((best(g), dict(rows)[best(g)]) for g in groups.values())


def targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """By the rule: share by weight, stop at the limit, share the rest anew until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, free = dict.fromkeys(names, 0.0), share * sum(sizes.values()), set(names)
    while left > 1e-9 and free:
        total = sum(w[s] for s in free)
        for s in free:
            target[s] += left * w[s] / total
        left = 0.0
        for s in list(free):
            if target[s] >= most * sizes[s]:
                left += target[s] - most * sizes[s]
                target[s] = most * sizes[s]
                free.discard(s)
    return target


def test_mixture(docs):
    rng = random.Random(5)
    rows = [(i, " ".join("w" * (1 + i % 3) for _ in range(rng.choice([0, 1, 5, 40, 300]))) or None, "en", rng.choice(["a"] * 6 + ["b", "é", "Z", None]))
            for i in range(400)]
    table = docs(rows).repartition(4)
    found = mixing.mixture(table).collect()
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, *_ in rows}
    source = {r[0]: r[3] for r in rows}
    sizes = {}
    for i, n in size.items():
        sizes[source[i]] = sizes.get(source[i], 0) + n
    want, taken = targets(sizes), dict.fromkeys(sizes, 0)
    for r in found:
        i = r["doc_id"]
        assert (r["size"], r["source_size"]) == (size[i], sizes[source[i]])
        assert r["target"] == pytest.approx(want[source[i]]) and 0 <= r["taken"] <= 2 * size[i]
        taken[source[i]] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 1, s
    assert sorted(map(tuple, mixing.mixture(docs(rows).repartition(2)).collect())) == sorted(map(tuple, found))
    # epochs first: no document a second (third) time while another of its source is still to come
    for s in sizes:
        times = [r["taken"] / r["size"] for r in found if source[r["doc_id"]] == s and r["size"]]
        assert max(times) - min(times) <= 1
    mixed = mixing.mixed_documents(table).collect()
    words = {}
    for r in mixed:
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + len(r["text"].split())
        assert dict((x[0], x[1]) for x in rows)[r["doc_id"]].startswith(r["text"]) and r["n_chars"] == len(r["text"])
    assert words == {r["doc_id"]: r["taken"] for r in found if r["taken"]}


def test_better_documents_come_sooner(docs, spark):
    rows = [(i, "one two three", "en", "a" if i < 2000 else "b") for i in range(4000)]
    marks = spark.createDataFrame([(i, i % 2) for i in range(4000)], "doc_id bigint, quality int")
    taken = {r["doc_id"]: r["taken"] for r in mixing.mixture(docs(rows), marks, weights=(1, 3), share=1.0).collect()}
    good, bad = (sum(taken[i] > 0 for i in range(k, 2000, 2)) for k in (1, 0))
    assert good > 2 * bad > 0


def test_fingerprints(docs):
    rng = random.Random(2)
    rows = [(i * 3, ".\n".join(" ".join(rng.choice("ab cd ef gh ij".split()) for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(0, 30))))
            for i in range(60)] + [(7, "é" * 10), (8, None), (10, "same text. here"), (11, "same text. here")]
    found = {r["doc_id"]: r for r in fingerprints.fingerprinted(docs(rows).repartition(4), parts=5).collect()}
    order = sorted(rows, key=lambda r: -r[0])

    def cells(text):
        return set(fingerprints.paragraphs([text])[0].tolist())

    def alike(a, b):
        a, b = cells(a), cells(b)
        return len(a & b) / len(a | b) if a | b else 1.0

    for k, (i, text) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        third = len(text) // 3
        changed = text[:len(text) - third] + after[:third]
        r = found[i]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert r["near_edited"] == pytest.approx(alike(text, changed)) and r["near_next"] == pytest.approx(alike(text, after))
    assert found[10]["fingerprint"] == found[11]["fingerprint"] and len({r["fingerprint"] for r in found.values()}) > 50


def test_likeness_from_the_strings_alone(docs):
    """Whatever two fingerprints of a table are taken, the strings tell what their texts share."""
    rng = random.Random(6)
    words = [f"w{i}" for i in range(400)]
    texts = ["", "one", ". ".join(rng.choice(words) for _ in range(900))]
    for _ in range(14):
        base = rng.choice(texts)
        texts.append(base[:rng.randrange(len(base) + 1)] + "\n" + ".\n".join(" ".join(rng.choice(words) for _ in range(9)) for _ in range(rng.choice([0, 1, 8, 120]))))
    found = {r["doc_id"]: r for r in fingerprints.fingerprinted(docs(list(enumerate(texts))).repartition(3), parts=2).collect()}
    sets = [set(fingerprints.paragraphs([t])[0].tolist()) for t in texts]
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            told = fingerprints.likeness(found[i]["fingerprint"], found[j]["fingerprint"])
            assert told == pytest.approx(len(a & b) / len(a | b) if a | b else 1.0), (i, j)
        after = found[(i - 1) % len(texts)]
        assert found[i]["near_edited"] == fingerprints.likeness(found[i]["fingerprint"], found[i]["edited_fingerprint"])
        assert found[i]["near_next"] == fingerprints.likeness(found[i]["fingerprint"], after["fingerprint"])


@given(st.lists(st.integers(0, 2**64 - 1), unique=True, max_size=90), st.lists(st.integers(0, 2**64 - 1), unique=True, max_size=60), st.integers(0, 60))
@settings(max_examples=60, deadline=None)
def test_sketches_recover_the_difference(a, b, both):
    a, b = set(a), set(b) | set(a[:both])
    keys = np.array(sorted(a) + sorted(b), np.uint64)
    rows = np.repeat([0, 1], [len(a), len(b)])
    found = fingerprints.Sketches.of(keys, rows, 2)
    assert found.differing(np.array([0]), np.array([1]))[0] == len(a ^ b)
    again = fingerprints.Sketches.read(found.texts())
    assert again.differing(np.array([1, 0]), np.array([0, 0])).tolist() == [len(a ^ b), 0] and again.texts() == found.texts()
    # folded tables are the tables of that size
    small = fingerprints.Tables(np.array([16, 16]))
    small.add(keys, rows, np.ones(len(keys), np.uint8))
    folded = fingerprints.Tables(np.array([16, 16]))
    folded.add_folded(found, np.array([0, 1]), 1)
    assert (small.keys == folded.keys).all() and (small.count == folded.count).all() and (small.checks == folded.checks).all()
    tables = fingerprints.Tables(np.array([256]))
    tables.add(np.array(sorted(a), np.uint64), np.zeros(len(a), np.int64), np.full(len(a), 1, np.uint8))
    tables.add(np.array(sorted(b), np.uint64), np.zeros(len(b), np.int64), np.full(len(b), 255, np.uint8))
    recovered, _, signs = tables.peel()
    assert {(k, s) for k, s in zip(recovered.tolist(), signs.tolist())} == {(k, 1) for k in a - b} | {(k, 255) for k in b - a}


PARTS = ["a", "th", "the", " ", "  ", "\n", "▁", "é", "日", "<s>", "<0x41>", "\t", "\x00", "ing", "tion", "0", "//", "\U0001f600", "́", " " * 17]


@given(st.lists(st.sampled_from(PARTS) | st.text(max_size=5), max_size=40).map("".join))
@settings(max_examples=400, deadline=None)
def test_pieces_are_the_library_s(text):
    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    library = test_pieces_are_the_library_s.__dict__.setdefault("library", sentencepiece.SentencePieceProcessor(model_file=path))
    text = text.encode("utf-8", "ignore").decode()
    ids = library.encode(text)
    joined, n, decoded = pieces.vocabulary(path).encode(text)
    assert (joined, n, decoded) == (",".join(map(str, ids)), len(ids), library.decode(ids))


def test_encoded_table(docs, model_path):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=model_path)
    rows = [(1, "Hello  world\n\nthis"), (2, ""), (3, None), (4, "Ouvrières " * 500)]
    for r in pieces.encoded(docs(rows), model_path, keep_ids=True).collect():
        ids = library.encode(dict(rows)[r["doc_id"]] or "")
        assert r["ids"] == ids and r["decoded"] == library.decode(ids) and r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


@pytest.mark.parametrize("version", ["1", "2"])
def test_arc_versions(version):
    body = warc.version_block("filedesc://x.arc", version) + "\n" + warc.arc_record(3, "http://a/", "<p>é</p>", version) + "\n" + \
        warc.arc_record(4, None, None, version) + "\n"
    records = list(warc.arc_records(gzip.compress(body.encode())))
    assert [r[1]["URL"] for r in records] == ["http://a/", warc.NO_URL] and list(records[0][1]) == warc.FIELDS[version]
    assert [warc.http_parts(r[2])[1:] for r in records] == [("<p>é</p>".encode(), 3), (b"", 4)]
    same = warc.First("x.arc", records[0][0], 3, "http://a/", "20000101000003")
    made = [warc.warc_info("x.arc", 0), *warc.converted(gzip.compress(body.encode()), {records[1][0]: same}, "x.arc")]
    found = list(warc.warc_records(gzip.compress(b"".join(r + b"\r\n\r\n" for r in made))))
    assert [h["WARC-Type"] for h, _ in found] == ["warcinfo", "response", "revisit"]
    assert found[1][0]["WARC-Date"] == "2000-01-01T00:00:03Z" and found[1][0]["WARC-Record-ID"].startswith("<urn:uuid:")
    with pytest.raises(ValueError):
        list(warc.arc_records(gzip.compress(body.encode()[:-20])))


#: Files as crawlers left them: a DNS answer first, no page ids, blanks in a URL, bytes that are no text, short headers.
ICON = bytes(range(256)) * 2
FOREIGN = {
    "1": [("dns:a.example", "20010203040506", "text/dns", b"20010203040506\na.example. 60 IN A 10.0.0.1\n"),
          ("http://a.example/x y", "20010203040507", "text/html", b"HTTP/1.0 200 OK\nContent-Type: text/html\n\n<p>\xff\xfe</p>"),
          ("http://a.example/i", "200102", "image/gif", b"HTTP/1.0 200 OK\r\n\r\n" + ICON),
          ("http://a.example/none", "?", "no-type", b"HTTP/1.0 304 Not Modified\r\nServer: x")],
    "2": [("http://b.example/i", "20010203040508", "image/gif", b"HTTP/1.1 200 OK\r\nX-Page-Id: many\r\n\r\n" + ICON),
          ("ftp://b.example/i", "20010203040509", "no-type", ICON), ("http://b.example/", "20010203040510", "text/html", b"")],
}


def foreign_arc(version):
    """One piece per record, the version block first."""
    body = f"{version} 1 crawler\n{' '.join(warc.FIELDS[version])}\n<about/>\n".encode()
    more = "200 - - 0 f " if version == "2" else ""
    yield f"filedesc://f{version}.arc 0.0.0.0 20010203040506 text/plain {more}{len(body)}\n".encode() + body + b"\n"
    for url, date, media, block in FOREIGN[version]:
        yield f"{url} 10.0.0.1 {date} {media} {more}{len(block)}\n".encode() + block + b"\n"


def test_foreign_archives(spark, tmp_path):
    """Plain files, one gzip member, one member a record, and joined files, of both versions."""
    source = tmp_path / "arc"
    source.mkdir()
    (source / "a1.arc").write_bytes(b"".join(foreign_arc("1")))
    (source / "b2.arc.gz").write_bytes(b"".join(gzip.compress(p) for p in foreign_arc("2")))
    (source / "c.arc.gz").write_bytes(gzip.compress(b"".join([*foreign_arc("2"), *foreign_arc("1")])))
    warc.convert(spark, str(source), str(tmp_path / "warc"), pattern="*.arc*")
    found = warc.read_warc(spark, str(tmp_path / "warc")).collect()
    digest = lambda b: hashlib.sha256(b).hexdigest()
    rows = Counter((r["url"], r["record_type"], r["payload_bytes"], r["payload_digest"], r["date"]) for r in found)
    icon, page = digest(ICON), b"<p>\xff\xfe</p>"
    again = "revisit"
    assert rows == Counter({
        ("dns:a.example", "resource", 43, digest(FOREIGN["1"][0][3]), "2001-02-03T04:05:06Z"): 2,
        ("http://a.example/x%20y", "response", len(page), digest(page), "2001-02-03T04:05:07Z"): 2,
        ("http://a.example/i", "response", 512, icon, "2001-02-01T00:00:00Z"): 1, ("http://a.example/i", again, 512, icon, "2001-02-01T00:00:00Z"): 1,
        ("http://a.example/none", "response", 0, digest(b""), "2000-01-01T00:00:00Z"): 2,
        ("http://b.example/i", again, 512, icon, "2001-02-03T04:05:08Z"): 2, ("ftp://b.example/i", again, 512, icon, "2001-02-03T04:05:09Z"): 2,
        ("http://b.example/", "resource", 0, digest(b""), "2001-02-03T04:05:10Z"): 2,
    })
    assert {r["page_id"] for r in found} == {None}
    headers = [h for f in (tmp_path / "warc").glob("part-*") for h, _ in warc.warc_records(f.read_bytes())]
    ids = {h["WARC-Record-ID"] for h in headers}
    assert len(ids) == len(headers) and all(h["WARC-Refers-To"] in ids for h in headers if h["WARC-Type"] == again)


def test_rolled_archives(spark, tmp_path, monkeypatch):
    """No file is longer than the bound and one record, and nothing depends on where files end."""
    records = [b"x" * n for n in (5, 50, 1, 1, 99, 7)]
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 50)
    assert list(warc.archives(iter(records), lambda n: b"<%d>" % n, b",")) == [
        b",".join([b"<0>", *records[:2]]), b",".join([b"<1>", *records[2:5]]), b",".join([b"<2>", records[5]])]
    assert list(warc.archives(iter([]), lambda n: b"", b",")) == []
    foreign = b"".join(b"%s\r\n" % line for line in [
        b"WARC/1.0", b"warc-type: response", b"WARC-Target-URI: http://c/", b"content-length: 25", b"WARC-Payload-Digest: sha1:ABC", b"X-Note: a", b" b", b""])
    (tmp_path / "f.warc").write_bytes(foreign + b"HTTP/1.1 200 OK\r\n\r\npayload"[:25] + b"\r\n\r\n")
    row = warc.read_warc(spark, str(tmp_path), "*.warc").first()
    assert (row["url"], row["payload_bytes"], row["payload_digest"]) == ("http://c/", 6, hashlib.sha256(b"payloa").hexdigest())
