"""Media, licences, token files, top-k and page text: round trips and brute force on small fixtures."""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from vellum.llm import html_text as H
from vellum.llm import licences as L
from vellum.llm import media, token_files, top_k

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
ODD = [None, "", "a", "BM RIFF P5 \x89PNG", "P5 1 1 255 x", "x" * 576, "é" * 300_000, "RIFF\x04\x00\x00\x00WAVE", "BM" * 1000]


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOCS)


# ---- media


def test_media_round_trip(spark):
    rows = {r.doc_id: r for r in media.media_digests(docs_of(spark, ODD + [f"text {i}" for i in range(40)])).collect()}
    for i, text in enumerate(ODD):
        raw = (text or "").encode()
        payload = raw + b"\xff" * ((-len(raw)) % 576 if raw else 576)
        r = rows[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
        stored = media.WRITERS[media._kind_of(payload)](payload)
        assert (r.media_bytes, r.media_sha256) == (len(stored), hashlib.sha256(stored).hexdigest())
    assert {r.feature.split(";")[0] for r in rows.values()} == {f"type={k}" for k in media.WRITERS}


def test_equal_texts_have_equal_values(spark):
    rows = media.media_digests(docs_of(spark, ["same", "same"])).drop("doc_id").collect()
    assert rows[0] == rows[1]


@pytest.mark.parametrize("kind", list(media.WRITERS))
def test_formats_are_validated(kind):
    payload = bytes(range(256)) * 9
    whole = media.WRITERS[kind](payload)
    assert media.finds(whole) == [(kind, 0, len(whole), payload)]
    assert media.finds(whole[:-1]) == []
    assert media.finds(b"BM junk RIFF" + whole + b"tail") == [(kind, 12, len(whole), payload)]


def test_carving_and_declared_types(spark):
    one, two = media.png(b"\x01" * 576), media.wav(b"\x02" * 576)
    df = spark.createDataFrame([(1, "png", bytearray(one)), (2, "jpg", bytearray(b"head" + two + b"mid" + one)), (3, "png", None), (4, "png", bytearray(b""))], "doc_id bigint, declared string, media binary")
    got = sorted(tuple(r) for r in media.sniff(df).collect())
    assert got == [(1, "png", 0, len(one)), (2, "png", 7 + len(two), len(one)), (2, "wav", 4, len(two))]
    assert sorted((r.doc_id, bytes(r.carved)) for r in media.carve(df).collect()) == sorted([(1, one), (2, two), (2, one)])
    assert media.sniff(df.limit(0)).count() == 0


def test_media_of_other_depths_are_found():
    head = media.struct.pack(">IIBBBBB", 2, 1, 8, 2, 0, 0, 0)
    rgb = media.MAGIC["png"] + media._chunk(b"IHDR", head) + media._chunk(b"IDAT", zlib.compress(b"\x01" + bytes(6))) + media._chunk(b"IEND", b"")
    info = media.struct.pack("<IiiHHIIiiII", 40, 3, 2, 1, 24, 0, 0, 0, 0, 0, 0)
    bmp = b"BM" + media.struct.pack("<IHHI", 54 + 24, 0, 0, 54) + info + bytes(24)
    sound = media.struct.pack("<4sIHHIIHH", b"fmt ", 16, 1, 2, 8000, 32000, 4, 16) + b"data" + media.struct.pack("<I", 8) + bytes(8)
    wav = b"RIFF" + media.struct.pack("<I", 4 + len(sound)) + b"WAVE" + sound
    for kind, data in (("png", rgb), ("bmp", bmp), ("wav", wav), ("pgm", b"P5 # made\n2 1 # by hand\n65535\n" + bytes(4)), ("pgm", b"P5 2 1 15\n" + bytes(2))):
        assert [f[:3] for f in media.finds(b"head" + data + b"tail")] == [(kind, 4, len(data))]
        assert media.finds(data[:-1]) == []


def plain_png(data):
    """Samples of an 8-bit grey PNG read chunk by chunk, filters by the letter of the standard."""
    spot, packed = 8, b""
    while spot < len(data):
        size, kind = int.from_bytes(data[spot : spot + 4], "big"), data[spot + 4 : spot + 8]
        if kind == b"IHDR":
            width, height = int.from_bytes(data[spot + 8 : spot + 12], "big"), int.from_bytes(data[spot + 12 : spot + 16], "big")
            back = {0: 1, 2: 3, 6: 4}[data[spot + 17]]
        if kind == b"IDAT":
            packed += data[spot + 8 : spot + 8 + size]
        spot += 12 + size
    lines, step, rows = zlib.decompress(packed), width * back, [[0] * (width * back)]
    for y in range(height):
        kind, line, row = lines[y * (step + 1)], lines[y * (step + 1) + 1 : (y + 1) * (step + 1)], []
        for x in range(step):
            a, b, c = row[x - back] if x >= back else 0, rows[-1][x], rows[-1][x - back] if x >= back else 0
            p = a + b - c
            paeth = a if abs(p - a) <= abs(p - b) and abs(p - a) <= abs(p - c) else b if abs(p - b) <= abs(p - c) else c
            row.append((line[x] + [0, a, b, (a + b) // 2, paeth][kind]) % 256)
        rows.append(row)
    return b"".join(map(bytes, rows[1:]))


def plain_bmp(data):
    start, width, height = (int.from_bytes(data[i : i + 4], "little", signed=True) for i in (10, 18, 22))
    rows = [data[start + y * width : start + (y + 1) * width] for y in range(abs(height))]
    return b"".join(rows if height < 0 else rows[::-1])


def test_stored_forms_are_read_by_other_decoders():
    import io
    import wave

    for payload in (bytes(range(256)) * 9, b"\xff" * 576, np.random.default_rng(1).bytes(576 * 5)):
        with wave.open(io.BytesIO(media.wav(payload))) as sound:
            assert (sound.getnchannels(), sound.getsampwidth(), sound.readframes(10**6)) == (1, 1, payload)
        assert plain_png(media.png(payload)) == plain_bmp(media.bmp(payload)) == payload
        head, size, depth, samples = media.pgm(payload).split(b"\n", 3)
        assert (head, depth, samples) == (b"P5", b"255", payload) and np.prod([int(x) for x in size.split()]) == len(payload)


@pytest.mark.parametrize("colour, back", [(0, 1), (2, 3), (6, 4)])
def test_png_filters_are_undone(colour, back):
    random = np.random.default_rng(colour)
    width, height = 7, 10
    lines = b"".join(bytes([y % 5]) + random.bytes(width * back) for y in range(height))
    head = media.struct.pack(">IIBBBBB", width, height, 8, colour, 0, 0, 0)
    whole = media.MAGIC["png"] + media._chunk(b"IHDR", head) + media._chunk(b"IDAT", zlib.compress(lines)) + media._chunk(b"IEND", b"")
    assert media.finds(b"x" + whole) == [("png", 1, len(whole), plain_png(whole))]


def test_png_that_holds_more_than_it_promises_is_not_inflated():
    bomb = zlib.compress(bytes(50_000_000))
    for size in ((1, 1), (2**31 - 1, 2**31 - 1)):
        head = media.struct.pack(">IIBBBBB", *size, 8, 0, 0, 0, 0)
        whole = media.MAGIC["png"] + media._chunk(b"IHDR", head) + media._chunk(b"IDAT", bomb) + media._chunk(b"IEND", b"")
        assert media.finds(whole) == [("png", 0, len(whole), None)]


def test_jpeg_and_gif_are_carved(spark):
    def segment(kind, data):
        return bytes([255, kind]) + (len(data) + 2).to_bytes(2, "big") + data

    jpg = b"\xff\xd8" + segment(0xE0, b"JFIF\0") + segment(0xC0, b"\x08\0\x02\0\x02\x01\x01\x11\0") + segment(0xC4, bytes(18)) + segment(0xDA, b"\x01\x01\0\0?\0") + b"ab\xff\0c\xff\xd3d\xff\xd9"
    gif = b"GIF89a\x02\0\x02\0\x80\0\0" + bytes(6) + b"\x21\xf9\x04" + bytes(4) + b"\0" + b"\x2c" + bytes(8) + b"\0\x02\x03abc\0;"
    data = b"\xff\xd8\xff\xe0 no GIF8 no" + jpg + b"mid" + gif + b"end"
    assert [(k, data[a : a + n]) for k, a, n, _ in media.finds(data)] == [("jpg", jpg), ("gif", gif)]
    for whole in (jpg, gif):
        assert all(media.finds(whole[:n]) == [] for n in range(len(whole)))
    df = spark.createDataFrame([(1, "txt", bytearray(data))] * 2, "doc_id bigint, declared string, media binary")
    assert sorted(bytes(r.carved) for r in media.carve(df).collect()) == sorted([jpg, gif] * 2)


def test_media_inside_a_text_are_counted(spark):
    rows = media.media_digests(docs_of(spark, ["see P5 1 1 255 x and P5 2 1 255 yz", "no medium, P5 BM RIFF"])).collect()
    assert {r.doc_id: "embedded=2;" in r.feature for r in rows} == {0: True, 1: False}


# ---- licences


def test_licence_contract(spark):
    texts = [
        None, "", "no licence here", "Released under the MIT License.", "under the mit license under the MIT LICENSE", "Licensed under the Apache License, Version 2.0.",
        "Licensed under CC BY-NC 4.0.", "This work is licensed under the GNU General Public License, version 3.", "apache license version2", "underthe mit license", "éunder the mit license",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and its documentation files", "word " * 50_000 + "under the mit license", "the general public was free",
    ]
    rows = {r.doc_id: r for r in L.licence_scan(docs_of(spark, texts)).collect()}
    base = {3: ("mit", 1, 1, 1), 4: ("mit", 2, 0, 4), 5: ("apache-2", 1, 3, 3), 6: ("cc-by-nc", 1, 2, 2), 12: ("mit", 1, 50_000, 50_000)}
    for i in range(len(texts)):
        r = rows[i]
        label, n, a, z = base.get(i, ("", 0, None, None))
        assert (r.base_labels, r.n_base, r.first_word, r.last_word) == (label, n, a, z), i
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1
    assert rows[0].n_words == 0 and rows[12].n_words == 50_004
    assert rows[7].labels == "gpl" and rows[11].labels == "mit" and rows[2].labels == rows[13].labels == ""


def test_overlapping_places_all_count():
    words = b"cc by nc cc by nc cc by".split()
    assert sorted(L.base_places(words)) == [("cc-by-nc", 0), ("cc-by-nc", 3)]


def plain_scan(words):
    """Every template at every place, word by word."""
    out = []
    for label, text, keys in L.TEMPLATES:
        wanted, phrases = L.words_of(text), [L.words_of(k) for k in keys]
        for at in range(-len(wanted), len(words)):
            same = sum(0 <= at + q < len(words) and words[at + q] == w for q, w in enumerate(wanted))
            inside = words[max(at, 0) : max(at + len(wanted), 0)]
            if 10 * same >= 8 * len(wanted) and all(any(inside[i : i + len(p)] == p for i in range(len(inside))) for p in phrases):
                out.append((label, at, same / len(wanted)))
    return out


def plain_base(words):
    return [(label, i) for phrase, label in L.BASE.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.encode().split()]


def test_scans_equal_every_template_at_every_place():
    random = np.random.default_rng(12)
    texts = [L.words_of(t) for _, t, _ in L.TEMPLATES]
    every = sorted({w for t in texts for w in t})
    bases = [p.encode().split() for p in L.BASE]
    found = 0
    for turn in range(60):
        words: list[bytes] = []
        for _ in range(int(random.integers(0, 5))):
            words += [every[k] for k in random.integers(0, len(every), int(random.integers(0, 12)))]
            own = list(texts[int(random.integers(0, len(texts)))])[int(random.integers(0, 2)) * int(random.integers(0, 5)) :]
            for k in random.integers(0, len(own), int(random.integers(0, len(own) // 4 + 1))):
                own[k] = every[int(random.integers(0, len(every)))]
            words += own + bases[int(random.integers(0, 3))] * int(random.integers(0, 3))
        counts = {w.decode(): int(random.integers(0, 50)) for w in every} | {"": 50}
        got = L.Index(counts).scan(words)
        assert sorted(got) == sorted(plain_scan(words)), turn
        assert sorted(L.base_places(words)) == sorted(plain_base(words))
        found += len(got)
    assert found > 60


def test_whole_bodies_get_their_labels():
    index = L.Index({})
    for label, text, _ in L.TEMPLATES:
        assert label in {m[0] for m in index.scan(L.words_of(f"Copyright (c) 2020 A B\n{text} and more"))}


def plain_in_order(words, wanted, at, room):
    """The longest common subsequence by the whole table, where only places of the band may match."""
    table = [[0] * (len(words) + 1) for _ in range(len(wanted) + 1)]
    for q, w in enumerate(wanted):
        for i, v in enumerate(words):
            hit = w == v and abs(i - q - at) <= room
            table[q + 1][i + 1] = max(table[q][i] + hit, table[q][i + 1], table[q + 1][i])
    return table[-1][-1]


def test_common_subsequences_equal_the_whole_table():
    random = np.random.default_rng(5)
    for _ in range(60):
        words, body = random.integers(0, 4, int(random.integers(1, 15))), random.integers(1, 4, int(random.integers(1, 9)))
        room, at = int(random.integers(1, 4)), np.arange(-12, 18)
        got = L.in_order(words.astype(np.int32), body.astype(np.int32), at, room)
        assert got.tolist() == [plain_in_order(words.tolist(), body.tolist(), int(a), room) for a in at]


def bodies():
    return [(t, label, L.words_of(text), [L.words_of(k) for k in keys]) for t, (label, text, keys) in enumerate(L.TEMPLATES) if len(L.words_of(text)) >= L.BODY]


def test_a_word_more_or_less_anywhere_keeps_the_label_of_a_body():
    index, tried, every = L.Index({}), 0, {label for label, _, _ in L.TEMPLATES}
    for _, label, words, keys in bodies():
        for j in range(len(words)):
            for other in (words[:j] + words[j + 1 :], words[:j] + [b"zzz"] + words[j:]):
                whole = all(L.has(other, 0, len(other), k) for k in keys)
                got = {m[0] for m in index.aligned([b"copyright", b"someone"] + other + [b"end"], frozenset(every - {label}))}
                assert (label in got) or not whole, (label, j)
                tried += whole
    assert tried > 1500


def test_offsets_of_bodies_equal_every_offset():
    """The index leaves out no offset at which enough words of a body stand in order; frequencies only choose the words indexed."""
    random, found = np.random.default_rng(31), 0
    for _ in range(12):
        t, _, words, _ = bodies()[int(random.integers(0, len(bodies())))]
        words = words[: len(words)]
        for _ in range(int(random.integers(0, 4))):
            j = int(random.integers(0, len(words)))
            words = words[:j] + [b"of", b"zzz"][: int(random.integers(0, 3))] + words[j + int(random.integers(0, 3)) :]
        index = L.Index({w.decode(): int(random.integers(0, 50)) for w in L._template_words()} | {"": 50})
        ids = np.array([index.codes.get(w, 0) for w in words], np.int32)
        near = dict(index.centres(words))
        for k, (_, wanted, _) in enumerate(index.templates):
            if len(wanted) >= L.BODY:
                at = np.arange(-len(wanted), len(words))
                enough = at[L.in_order(ids, np.array([index.codes[w] for w in wanted], np.int32), at, int(index.slack[k])) >= L.least_words(wanted)]
                assert np.isin(enough, near.get(k, [])).all()
                found += len(enough)
    assert found > 12


def test_titles_identifiers_and_notices(spark):
    want = {
        "SPDX-License-Identifier: MIT": "mit", "// spdx-license-identifier: GPL-3.0-or-later": "gpl-3", "SPDX-License-Identifier: BSD-3-Clause": "bsd-3",
        "GNU GENERAL PUBLIC LICENSE\n   Version 2, June 1991": "gpl-2", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007": "agpl-3",
        "Apache License\n  Version 2.0, January 2004": "apache-2", "free under the terms of the MIT license": "mit", "It is under the GPLv3.": "gpl-3",
        "a text of 29 June 2007, version 3": "", "an identifier of a license": "", "under the terms of the license": "",
    }
    rows = L.licence_scan(docs_of(spark, list(want))).orderBy("doc_id").collect()
    assert [r.labels for r in rows] == list(want.values())


def test_many_places_take_linear_time():
    import time

    def seconds(n):
        words = L.words_of("under the mit license " * n)
        begun = time.perf_counter()
        assert len(L.base_places(words)) == n
        return time.perf_counter() - begun

    seconds(1000)
    assert seconds(80_000) < 40 * max(seconds(8_000), 0.002)


def test_licences_of_an_empty_table_and_frequencies(spark):
    assert L.licence_scan(spark.createDataFrame([], DOCS)).count() == 0
    counts = {r.word: r.n for r in L.document_frequencies(docs_of(spark, ["the MIT license license", "license", "x"])).collect()}
    assert counts == {"": 3, "license": 2, "mit": 1, "the": 1}


# ---- token files


def test_token_counts(spark):
    texts = ODD + ["some words " * i for i in range(200)]
    got = {r.doc_id: r.n_tokens for r in token_files.count_tokens(docs_of(spark, texts).repartition(3, "doc_id"), block=512).collect()}
    assert got == {i: len(ids) for i, ids in enumerate(token_files.token_ids(texts))}
    for file_bytes, n in ((1, 25), (9_000, len(texts))):
        rows = token_files.count_tokens(docs_of(spark, texts[:n]).repartition(3, "doc_id"), block=512, file_bytes=file_bytes).collect()
        assert {r.doc_id: r.n_tokens for r in rows} == {i: got[i] for i in range(n)} and len({r.token_file for r in rows}) > 3
        assert file_bytes > 1 or {r.doc_no for r in rows} == {0}
    assert token_files.count_tokens(spark.createDataFrame([], DOCS)).count() == 0


@pytest.mark.parametrize("deal", ["repartition", "groupBy", "join", "names"])
def test_token_counts_behind_shuffles(spark, deal):
    """Plans that give their rows in another order, or other files, each time that they run."""
    texts = [f"text {i} " * (i % 97) for i in range(3_000)]
    docs = docs_of(spark, texts)
    want = {i: len(ids) for i, ids in enumerate(token_files.token_ids(texts))}
    if deal == "repartition":
        docs = docs.repartition(16)
    elif deal == "groupBy":
        docs = docs.groupBy("doc_id").agg(F.first("text").alias("text"))
    elif deal == "join":
        docs = docs.join(docs.select("doc_id", F.rand().alias("r")), "doc_id").orderBy("r")
    else:  # ids of other types, nulls among them
        docs, want = docs.select(F.when(F.col("doc_id") % 7 > 0, F.concat(F.lit("é -c4/"), "doc_id")).alias("doc_id"), "text"), None
    rows = token_files.count_tokens(docs, file_bytes=200_000).collect()
    assert len(rows) == 3_000
    if want:
        assert {r.doc_id: r.n_tokens for r in rows} == want
    else:
        sizes = sorted((f"é -c4/{i}" if i % 7 else "", len(ids)) for i, ids in enumerate(token_files.token_ids(texts)))
        assert sorted((r.doc_id or "", r.n_tokens) for r in rows) == sizes


@pytest.mark.parametrize("block", [2, 4, 6, 64, 1 << 20])
def test_scan_equals_a_plain_split(spark, tmp_path, block):
    sep = token_files.SEPARATOR
    streams = {"part-0": [sep, 1, 2, sep, sep, 3], "part-1": [5] * 20 + [sep], "part-2": [0x50, 0xC450, 0x5050], "part-3": [0x5000, 0x00C4, sep]}
    for name, ids in streams.items():
        (tmp_path / name).write_bytes(np.array(ids, "<u2").tobytes() + (b"\x07" if name == "part-1" else b""))
    want = []
    for name, ids in streams.items():
        start = n = 0
        for i, x in enumerate(ids):
            if x == sep:
                want.append((name, n, start, i - start, True))
                start, n = i + 1, n + 1
        if start < len(ids):
            want.append((name, n, start, len(ids) - start, False))
    got = sorted(tuple(r) for r in token_files.scan_token_files(spark, str(tmp_path), block).collect())
    assert got == sorted(want)


# ---- top-k


def plain_top_k(rows, k, every, scale=64):
    q = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            q.append((i, [math.floor(scale * float(np.float32(x))) for x in v]))
    out = []
    for a in {i for i, _ in q if i % every == 0}:
        best = sorted((-sum(x * y for x, y in zip(v, w)), b) for i, v in q if i == a for b, w in q if b != a)[:k]
        out += [(a, r, b, -s) for r, (s, b) in enumerate(best, 1)]
    return sorted(out)


def test_top_k_equals_brute_force(spark):
    random = np.random.default_rng(3)
    base = random.normal(0, 0.2, (300, 48)).astype(np.float32)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(base)]
    rows += [(300 + i, rows[i % 7][1]) for i in range(60)]  # ties
    rows += [(400, None), (401, [None] * 48), (402, [float("nan")] * 48), (403, [float("inf")] * 48), (404, []), (405, [1.0]), (None, rows[0][1]), (406, [3e8] * 4), (0, rows[5][1]), (7, rows[8][1]), (7, rows[7][1]), (7, rows[7][1])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id bigint, embedding array<float>, id int")
    want = plain_top_k(rows, 20, 20)
    for block, sample in ((64, 4096), (64, 40), (100_000, 64)):
        assert sorted(tuple(r) for r in top_k.top_k(df, F.col("id") % 20 == 0, k=20, block=block, sample=sample).collect()) == want
    fine = [r for r in rows if r[0] != 406]  # without the vector whose products are past exact floating point, bounds come from the sample
    df = spark.createDataFrame([(i, v, 0) for i, v in fine], df.schema)
    for block, sample in ((64, 4096), (64, 40), (100_000, 64)):
        assert sorted(tuple(r) for r in top_k.top_k(df, F.col("id") % 20 == 0, k=20, block=block, sample=sample).collect()) == plain_top_k(fine, 20, 20)


def test_top_k_edges(spark):
    schema = "vec_id bigint, embedding array<float>"
    assert top_k.top_k(spark.createDataFrame([], schema), F.col("id") % 20 == 0).count() == 0
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (2, [-0.01])], schema)
    assert sorted(tuple(r) for r in top_k.top_k(few, F.col("id") % 20 == 0, k=20).collect()) == [(0, 1, 1, 8192), (0, 2, 2, -64)]


def test_top_k_of_an_id_and_of_a_row_that_hold_most_rows(spark):
    random = np.random.default_rng(4)
    vector = lambda: [float(x) for x in random.normal(0, 0.3, 6)]
    rows = [(i, vector()) for i in range(60)] + [(7, vector()) for _ in range(150)] + [(20, vector()) for _ in range(30)]
    rows += [(8, rows[8][1])] * 200 + [(40, rows[40][1])] * 40
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    rows = [(r.vec_id, list(r.embedding)) for r in df.collect()]
    for block in (32, 100_000):
        assert sorted(tuple(r) for r in top_k.top_k(df, F.col("id") % 20 == 0, k=20, block=block).collect()) == plain_top_k(rows, 20, 20)


# ---- pages

ARTICLE = "<html><head><title>t</title><style>x</style></head><body><nav>menu one two three four</nav><div class='ad'>buy</div><article><h1>Head &amp; more</h1><p>First <b>bold</b>\n<span class='ad-slot'>no</span> text<p>Second&nbsp;one<br>line</p><script>var a='</p>';</script><div class='comments'><p>me too</p></div></article><footer>foot</footer>"


def test_article_text(spark):
    rows = [(1, "http://h/a", ARTICLE), (2, None, None), (3, "odd", ""), (4, "http://h/b", "<p>only open text here"), (5, "http://h/c", "<form>a</form><!-- x -->")]
    got = {r.page_id: (r.text, r.n_chars) for r in H.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    want = "Head & more\nFirst bold text\nSecond one line"
    assert got == {1: (want, len(want)), 2: ("", 0), 3: ("", 0), 4: ("only open text here", 19), 5: ("", 0)}


@pytest.mark.parametrize("html, want", [
    ("<div class='layout has-sidebar'><article><p>kept</p></article><div class='sidebar'>no</div></div>", "kept"),
    ("<div class='widget'><article><p>kept</p></article></div>", "kept"),
    ("<div class='sidebar'><article>teaser</article></div><article>kept</article>", "kept"),
    ("<article>kept</article><aside><article>teaser</article></aside>", "kept"),
    ("<article><div class='post-header'><h1>Title</h1></div><p>kept</p></article>", "Title\nkept"),
    ("<article><div class='entry-header header'><h1>Title</h1></div><header><h2>Sub</h2></header></article>", "Title\nSub"),
    ("<article><section class='ad-hoc-analysis'><p>kept</p></section><div class='ad-slot'>no</div><div id='ad-1'>no</div></article>", "kept"),
    ("<article><p>kept</p><div class='social-share-buttons'>no</div><div class='related-posts'>no</div><div class='comment_list'>no</div></article>", "kept"),
    ("<article><p class='promotion-policy'>kept</p><div class='newsletter-signup'>no</div><div class='site-header'>no, but a header</div></article>", "kept\nno, but a header"),
    ("<div class='page-header'>no</div><div class='cookie-banner'>no</div><p>open</p>", "open"),
    ("<body class='no-sidebar'><main><p>kept</p></main></body>", "kept"),
])
def test_names_of_parts(html, want):
    assert "\n".join(t for k, t in H.blocks_of(html) if k != H.NOISE) == want


def test_every_repeat_of_a_host_goes_whatever_its_size(spark):
    """Every two pages of one host share a notice; 700 pages are parsed in several parts."""
    for n in (240, 700):
        rows = [(i, "http://big/x", f"<p>{' '.join(f'{w}{i}' for w in 'own words of this page only'.split())}</p><div>pages {i // 2} share these twelve words of notice number {i // 2} a b</div>") for i in range(n)]
        got = H.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(4)).collect()
        assert sorted(r.text for r in got) == sorted(" ".join(f"{w}{i}" for w in "own words of this page only".split()) for i in range(n))


def test_repeated_runs_of_open_pages_go(spark):
    head, foot = "<div>Site name and a long slogan</div>", "<div>All rights are reserved by someone</div>"
    rows = [(i, f"http://h.example/{i}", f"{head}<p>story {i} has its own words {i}{i}</p>{foot}") for i in range(5)]
    rows += [(9, "http://other/9", f"{head}<p>x</p>"), (3, "http://h.example/3", rows[3][2])]
    got = sorted((r.page_id, r.text) for r in H.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect())
    assert (9, "Site name and a long slogan\nx") in got
    assert [t for p, t in got if p == 3] == ["story 3 has its own words 33"] * 2


def test_quoted_passages_inside_articles_stay(spark):
    same = "<article><p>one passage that two pages quote in full</p></article>"
    df = spark.createDataFrame([(1, "http://h/1", same), (2, "http://h/2", same)], "page_id bigint, url string, html string")
    assert {r.text for r in H.main_text(df).collect()} == {"one passage that two pages quote in full"}


def test_covered_equals_brute_force():
    random = np.random.default_rng(0)
    for _ in range(60):
        n, least = int(random.integers(1, 60)), int(random.integers(2, 5))
        tokens, pages = random.integers(0, 3, n), np.sort(random.integers(0, 4, n))
        ends = np.concatenate((pages[1:] != pages[:-1], [True]))
        tokens = np.where(ends, -1 - np.arange(n), tokens)
        want = np.zeros(n, bool)
        grams = {}
        for i in range(n - least + 1):
            gram = tuple(tokens[i : i + least])
            if min(gram) >= 0:
                grams.setdefault(gram, []).append(i)
        for spots in grams.values():
            if len({pages[i] for i in spots}) > 1:
                for i in spots:
                    want[i : i + least] = True
        assert (H.covered(tokens, pages, least) == want).all()
        order = H.suffix_array(tokens)
        assert [list(tokens[i:]) for i in order] == sorted(list(tokens[i:]) for i in range(n))


def test_a_large_host_is_dealt_into_parts(spark, monkeypatch):
    monkeypatch.setattr(H, "PAGES", 10)
    monkeypatch.setattr(H, "BROADCAST", 0)
    rows = [(i, "http://big/x", f"<article><p>text {i}</p></article>") for i in range(60)]
    got = sorted(r.text for r in H.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect())
    assert got == sorted(f"text {i}" for i in range(60))
    assert H.main_text(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


def test_a_run_on_two_pages_of_a_large_host_goes(spark, monkeypatch):
    monkeypatch.setattr(H, "PAGES", 10)
    texts = [" ".join(f"{w}{i}" for w in ("own", "words", "of", "page", "number", "here", "end")) for i in range(200)]
    rows = [(i, "http://big/x", f"<p>{t}</p>" + "<div>seven words that only two pages share</div>" * (i in (3, 196))) for i, t in enumerate(texts)]
    rows += [(500, "http://other/x", "<div>seven words that only two pages share</div>"), (3, *rows[3][1:]), (None, "http://big/x", "<div>a null id is one page of its host</div>"), (None, "http://big/x", "<div>a null id is one page of its host</div>")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)
    want = sorted([*texts, texts[3], "seven words that only two pages share", *["a null id is one page of its host"] * 2])
    for broadcast in (0, 100_000):
        monkeypatch.setattr(H, "BROADCAST", broadcast)
        assert sorted(r.text for r in H.main_text(df).collect()) == want


def test_parts_give_what_one_suffix_array_gives(spark, monkeypatch):
    monkeypatch.setattr(H, "PAGES", 4)
    random = np.random.default_rng(8)
    lines = [[" ".join(random.choice(["a", "b", "c"], int(random.integers(1, 14)))) for _ in range(3)] for _ in range(40)]
    rows = [(i, "http://h/x", "".join(f"<p>{x}</p>" for x in own)) for i, own in enumerate(lines)]
    got = {r.page_id: r.text for r in H.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    streams = [" ".join(own).split(" ") for own in lines]
    tokens = np.array([x for i, own in enumerate(streams) for x in [*(ord(w) for w in own), -1 - i]])
    marks = H.covered(tokens, np.repeat(np.arange(40), [len(own) + 1 for own in streams]))
    at, want = 0, {}
    for i, own in enumerate(lines):
        kept = []
        for line in own:
            words = line.split(" ")
            kept.append(" ".join(w for w, m in zip(words, H.long_runs(marks[at : at + len(words)])) if not m))
            at += len(words)
        want[i] = "\n".join(filter(None, kept))
        at += 1
    assert got == want


@pytest.mark.parametrize("few", [0, 100_000])
def test_only_hosts_with_an_open_page_make_runs(spark, monkeypatch, few):
    """A page without open blocks tells what an open one of its host repeats; hosts of articles alone give the array nothing."""
    monkeypatch.setattr(H, "BROADCAST", few)
    line = "a line of seven words stands here"
    article = lambda i: f"<nav><p>{line}</p></nav><article><p>text {i}</p><p>{line}</p></article>"
    rows = [(1, "http://mixed/1", f"<p>own {1}</p><p>{line}</p>"), *((i, "http://mixed/2", article(i)) for i in (2, 3)), *((i, "http://closed/x", article(i)) for i in (4, 5)), (6, "http://alone/1", f"<p>{line}</p>")]
    got = {r.page_id: r.text for r in H.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)).collect()}
    assert got == {1: "own 1", **{i: f"text {i}\n{line}" for i in (2, 3, 4, 5)}, 6: line}
    names, write = [], H.written
    monkeypatch.setattr(H, "written", lambda df, name: names.append(name) or write(df, name))
    assert H.main_text(spark.createDataFrame(rows[3:5], "page_id bigint, url string, html string")).count() == 2 and names == ["pages"]


def test_what_stands_beside_an_article_in_the_main_part_is_judged_by_its_repeats(spark):
    """A line beside the article goes where other pages of the host have it and stays where none has; articles, mains without one and copies keep theirs."""
    line, own = "a line of seven words stands here", "a heading of page {} beside its article"
    page = lambda i, head=line: f"<nav>menu</nav><p>outside</p><main><div>{head}</div><h1>{own.format(i)}</h1><article><p>text {i}</p><p>{line}</p></article></main>"
    rows = [*((i, f"http://h/{i}", page(i)) for i in range(3)), (3, "http://h/3", page(3, "a notice that only this page of all has")), (4, "http://h/4", f"<main><p>{line}</p></main>")]
    rows += [(5, "http://copies/5", page(5)), (6, "http://copies/6", page(5)), (7, "http://h/7", f"<div role='main'><p>{line}</p><div role='article'>text 7</div></div>")]
    got = {r.page_id: r.text for r in H.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)).collect()}
    rest = {i: f"a heading of page {i} beside its article\ntext {i}\n{line}" for i in range(4)}
    copy = f"{line}\na heading of page 5 beside its article\ntext 5\n{line}"
    assert got == rest | {3: f"a notice that only this page of all has\n{rest[3]}", 4: line, 5: copy, 6: copy, 7: "text 7"}


@pytest.mark.parametrize("html, want", [
    ("<main><p>beside</p><article>kept</article></main><p>outside</p>", [("open", "beside"), ("content", "kept"), ("noise", "outside")]),
    ("<div id='main-content'><p>kept</p></div><p>outside</p>", [("content", "kept"), ("noise", "outside")]),
    ("<article>kept</article><main>too</main>", [("content", "kept"), ("open", "too")]),
    ("<main><article><p>kept</p></article><div class='ad'>no</div></main>", [("content", "kept"), ("noise", "no")]),
    ("<div class='widget'><main><p>kept</p></main></div>", [("content", "kept")]),
])
def test_kinds_of_blocks(html, want):
    assert H.blocks_of(html) == want


def test_query_texts_equal_a_plain_reading_of_the_articles(spark, sf_dir):
    """op7 over whole pages of the shared table, whose articles hold only headings, paragraphs, bold text and line breaks."""
    import html as entities
    import re

    from vellum.llm import queries

    got = {r.page_id: r for r in queries.op7_html(spark, sf_dir).collect()}
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    assert len(got) == len(pages)
    for page in pages:
        inner = re.search(r"<article[^>]*>(.*)</article>", page.html, re.S).group(1)
        blocks = (" ".join(entities.unescape(re.sub(r"<[^>]*>", "", re.sub(r"<br[^>]*>", " ", b))).split()) for b in re.split(r"</?(?:p|h1)>", inner))
        text = "\n".join(filter(None, blocks))
        assert (got[page.page_id].text, got[page.page_id].n_chars, got[page.page_id].url) == (text, len(text), page.url)
