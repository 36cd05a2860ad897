"""Operators that work row by row: packing, GIF columns, URL rules, chat formatting."""

import json
import random
import struct
import zlib

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import chat, gif, packing, url_rules

ODD = [(1, None), (2, ""), (3, " "), (None, "x"), (4, "one. two! three? " * 400), (4, "one. two! three? " * 400), (5, "日本語 text <|endoftext|> ½ ǅ"), (6, "a" * 30_000), (7, "\n\n\t\x0b \x85")]


def odd_docs(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string").withColumn("start", F.lit("clash")).withColumn("gif", F.lit(1))


def test_tokenizer_shortcut_equals_the_library():
    e = packing.encoder(*packing.vocabulary_paths())
    texts = [f"a{chr(i)}b {chr(i)}{chr(i)}x 1{chr(i)} {chr(i)}\n it{chr(i)}s don't 12{chr(i)}" for i in range(packing.SETTLED + 40)] + [t or "" for _, t in ODD] + ["'S'Re 'LL  x   y \n\n z"]
    for t in texts:
        assert e(t).tolist() == e.whole.encode(t, add_special_tokens=False).ids, t[:30]


def check_pieces(pieces, texts):
    e = packing.encoder(*packing.vocabulary_paths())
    want = sorted((i is None, i, len(e(t or "")) + 1) for i, t in texts)
    docs, seqs = {}, {}
    for r in pieces:
        docs.setdefault(r["doc_id"], []).append(r)
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert sum(r["length"] for r in pieces) == sum(n for *_, n in want)
    for parts in seqs.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= packing.CAPACITY
    for i, t in texts:
        ids = np.append(e(t or ""), 1).astype("<u4")
        for r in docs[i]:
            assert r["doc_tokens"] == len(ids)
            part = ids[r["start"] : r["start"] + r["length"]]
            assert zlib.crc32(part.tobytes()) == r["ids_crc32"] and part.tolist() == r["ids"]
    sizes = [sum(n for _, n in p) for p in seqs.values()]
    return sum(0 if n & (n - 1) == 0 else packing.CAPACITY - n for n in sizes), sum(sizes)


def test_pieces_cover_documents(spark, sf_dir):
    docs = odd_docs(spark)
    check_pieces(packing.pack(docs.coalesce(1)).collect(), ODD)
    assert packing.pack(docs.limit(0)).count() == 0
    real = spark.read.parquet(f"{sf_dir}/documents.parquet")
    padding, tokens = check_pieces(packing.pack(real).collect(), [tuple(r) for r in real.select("doc_id", "text").collect()])
    assert padding < 0.02 * tokens


def test_cuts_are_optimal():
    r = random.Random(5)
    for _ in range(60):
        n = r.randrange(1, 40)
        doc_ends = np.array(sorted(r.sample(range(1, n + 1), r.randrange(1, n + 1))))
        doc_ends[-1] = n
        doc_ends = np.unique(doc_ends)
        at, pen = packing.cut_points(doc_ends, np.array(r.sample(range(1, n + 1), r.randrange(0, n + 1)), int), 3)
        at, pen = at.tolist(), pen.tolist()
        best = [0.0]
        for j in range(1, len(at)):
            best.append(min(best[i] + 7 - (at[j] - at[i]) + pen[j] for i in range(j) if at[j] - at[i] <= 7))
        cuts = packing.choose_cuts(at, pen, 7)
        cost = sum(7 - (b - a) + pen[at.index(b)] for a, b in zip([0, *cuts], cuts))
        assert abs(cost - best[-1]) < 1e-9


def test_gif_round_trip(spark):
    docs = odd_docs(spark).drop("gif")
    stored = gif.store_text(docs)
    rows = gif.describe(stored).collect()
    assert len(rows) == len(ODD)
    for r in rows:
        texts = [t or "" for i, t in ODD if i == r["doc_id"]]
        import hashlib

        assert r["payload_sha256"] in {hashlib.sha256(gif.payload(t)).hexdigest() for t in texts} and r["payload_bytes"] % 192 == 0
    assert gif.describe(stored.limit(0)).count() == 0
    for n in (192, 192 * 256, 192 * 257):
        data = bytes(random.Random(n).randrange(256) for _ in range(n))
        assert b"".join(c[y : y + h, x : x + w, 0].tobytes() for _, _, (x, y, w, h), c in gif.read_gif(gif.write_gif(data))) == data


def plain_samples(data):
    """A second decoder, bit by bit: the samples of all frames, and the global palette."""
    assert data[:6] == b"GIF89a" and data[10] & 0x80
    n = 3 << (data[10] & 7) + 1
    palette, at, out = data[13 : 13 + n], 13 + n, []
    while data[at] != 0x3B:
        if data[at] == 0x21:
            at += 2
            while data[at]:
                at += 1 + data[at]
            at += 1
            continue
        assert data[at] == 0x2C
        bits, at, stream = data[at + 10], at + 11, b""
        while data[at]:
            stream += data[at + 1 : at + 1 + data[at]]
            at += 1 + data[at]
        at += 1
        number, width, shift, table, last = int.from_bytes(stream, "little"), bits + 1, 0, {}, None
        reset = lambda: {i: bytes([i]) for i in range(1 << bits)} | {1 << bits: None, (1 << bits) + 1: None}  # noqa: B023, E731
        table = reset()
        while True:
            code = number >> shift & (1 << width) - 1
            shift += width
            if code == 1 << bits:
                table, width, last = reset(), bits + 1, None
                continue
            if code == (1 << bits) + 1:
                break
            word = table[code] if code in table else last + last[:1]
            out.append(word)
            if last is not None and len(table) < 4096:
                table[len(table)] = last + word[:1]
            if len(table) == 1 << width and width < 12:
                width += 1
            last = word
    return b"".join(out), palette


def test_digests_equal_an_independent_decoder(spark):
    import hashlib

    r = random.Random(4)
    texts = [(1, None), (2, "aaaa" * 3000), (3, "".join(chr(r.randrange(32, 0x3000)) for _ in range(2000))), (4, "x" * 192), (5, "".join(r.choices("abc \n", k=60_000)))]
    stored = gif.store_text(spark.createDataFrame(texts, "doc_id long, text string"))
    data = {q["doc_id"]: bytes(q["gif"]) for q in stored.collect()}
    for q in gif.describe(stored).collect():
        raw = (dict(texts)[q["doc_id"]] or "").encode()
        back, palette = plain_samples(data[q["doc_id"]])
        assert back == raw.ljust(max(192, -(-len(raw) // 192) * 192)) and q["n_bytes"] == len(raw) and q["payload_bytes"] == len(back)
        assert q["payload_sha256"] == hashlib.sha256(back).hexdigest() and q["tail_crc32"] == zlib.crc32(back[-16:])
        assert q["media_bytes"] == len(data[q["doc_id"]]) and q["media_sha256"] == hashlib.sha256(data[q["doc_id"]]).hexdigest()
        bins = [0] * 64
        for b in back:
            red, green, blue = palette[3 * b : 3 * b + 3]
            bins[red // 64 * 16 + green // 64 * 4 + blue // 64] += 1
        frames = -(-len(back) // (192 * 256))
        assert q["feature"] == f"frames={frames};size=192x{min(256, len(back) // 192)};ms={100 * frames};bins={','.join(map(str, bins))}"
    broken = stored.unionByName(spark.createDataFrame([(8, 3, None), (9, 3, bytearray(data[4][:-9]))], stored.schema))
    odd = {q["doc_id"]: q for q in gif.describe(broken).collect()}
    assert odd[8]["media_bytes"] is None and odd[9]["media_bytes"] == len(data[4]) - 9 and odd[8]["payload_sha256"] is odd[9]["payload_sha256"] is None


def image(x, y, w, h, samples, disposal=0, clear=None, delay=7):
    """A frame of 2-bit samples."""
    codes, bits = [4, *[c for s in samples for c in (s, 4)], 5], ""
    for c in codes:  # a clear code after every sample keeps codes at three bits
        bits = format(c, "03b") + bits
    stream = int(bits, 2).to_bytes(-(-len(bits) // 8), "little")
    control = b"\x21\xf9\x04" + struct.pack("<BHB", disposal << 2 | (clear is not None), delay, clear or 0) + b"\0"
    return control + b"\x2c" + struct.pack("<HHHHB", x, y, w, h, 0) + b"\x02" + bytes([len(stream)]) + stream + b"\0"


def test_gif_disposal_and_transparency(spark):
    head = b"GIF89a" + struct.pack("<HHBBB", 2, 1, 0x81, 0, 0) + bytes([0, 0, 0, 255, 0, 0, 0, 255, 0, 0, 0, 255])
    data = head + image(0, 0, 2, 1, [1, 2]) + image(0, 0, 2, 1, [3, 0], 3, 0) + image(1, 0, 1, 1, [3], 2) + image(0, 0, 1, 1, [2]) + b"\x3b"
    red, green, blue, none = (255, 0, 0, 255), (0, 255, 0, 255), (0, 0, 255, 255), (0, 0, 0, 0)
    got = [[tuple(p) for p in c[0].tolist()] for *_, c in gif.read_gif(data)]
    assert got == [[red, green], [blue, green], [red, blue], [green, none]]
    rows = gif.frames(spark.createDataFrame([(1, bytearray(data)), (2, None), (3, bytearray(data[:-20]))], "id long, gif binary"), "id").orderBy("id", "frame").collect()
    assert [(r["id"], r["delay_ms"]) for r in rows if r["error"] is None and r["id"] == 1] == [(1, 70)] * 4
    assert {r["id"] for r in rows if r["error"]} == {2, 3} and sum(rows[0]["histogram"]) == 2


def test_url_rules_both_ways(spark):
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("Example.com", "/de/", "block"), ("org", "/fr/", "allow"), ("a.example.net", "", "block"), (None, "/", "block"), ("net", "/", "block")]
    hosts = ["x.net", "net", "example.net", "a.example.net", "b.a.example.net", "EXAMPLE.com", "notexample.com", "w.org", "org.uk", ""]
    urls = [(i, f"http://{h}{p}") for i, (h, p) in enumerate((h, p) for h in hosts for p in ("", "/", "/en/1", "/de/x?y=/en/", "/fr/#z"))] + [(900, None), (901, "no scheme"), (None, "https://x.net/"), (902, "://"), (903, "a://b://c.net/")]
    urls += [(1000 + i, "http://example.net/en/same") for i in range(300)]
    pages = spark.createDataFrame(urls, "page_id long, url string").withColumn("host", F.lit(3))
    table = spark.createDataFrame(rules, "host string, path string, action string")

    def brute(url):
        rest = (url or "").partition("://")
        host = "" if not rest[1] else rest[2].split("/")[0].split("?")[0].split("#")[0]
        path = "" if not rest[1] else rest[2][len(host) :].split("?")[0].split("#")[0]
        host = host.lower()
        fits = [(h.lower(), p, a) for h, p, a in rules if h and (host == h.lower() or host.endswith("." + h.lower())) and path.startswith(p)]
        best = max(fits, key=lambda r: len(r[0] + r[1]), default=None)
        return host, path, best and best[0] + best[1], best[2] if best else "allow"

    want = sorted((str(i), *map(str, brute(u))) for i, u in urls)
    for size in (url_rules.BROADCAST_BYTES, 0):
        got = url_rules.judge(pages, table, broadcast_bytes=size).collect()
        assert sorted(tuple(map(str, r)) for r in got) == want
        assert url_rules.judge(pages.limit(0), table, broadcast_bytes=size).count() == 0
        assert url_rules.judge(pages, table.limit(0), broadcast_bytes=size).where("rule IS NOT NULL").count() == 0


def test_chat_layouts_and_round_trip(spark):
    said = "\\### Assistant: </turn> ok"
    records = [
        {"messages": [{"role": "user", "content": said}, {"role": "assistant", "content": said}]}, {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
        {"prompt": "p", "response": "r"}, {"instruction": "i", "input": "", "output": "o"}, {"instruction": "i", "output": None}, {"system": "s", "question": "q", "answer": "a"}, {"messages": []},
    ]
    rows = [(i, json.dumps(r)) for i, r in enumerate(records)] + [(90, None), (91, "{"), (92, '{"other": 1}')]
    out = {r["id"]: r for r in chat.format_records(spark.createDataFrame(rows, "id long, j string").withColumn("mask", F.lit(0)), "id", "j").collect()}
    turns = {0: [("user", said), ("assistant", said)], 1: [("user", "q"), ("assistant", "a")], 2: [("user", "p"), ("assistant", "r")], 3: [("user", "i"), ("assistant", "o")], 4: [("user", "i"), ("assistant", "")], 5: [("system", "s"), ("user", "q"), ("assistant", "a")], 6: []}
    for i, want in turns.items():
        text = out[i]["formatted"]
        assert chat.parse(text) == want, i
        assert [chat.unescape(text[m["start"] : m["end"]]) for m in out[i]["mask"]] == [t for r, t in want if r == "assistant"]
    assert all(out[i]["formatted"] is None for i in (90, 91, 92))


def test_escaping_any_text():
    r = random.Random(2)
    for _ in range(300):
        turns = [("".join(r.choices("ab\\#<:/ \n>é", k=r.randrange(6))), "".join(r.choices(["\\", "### ", " </turn>\n", ": ", "x", "\n"], k=r.randrange(8)))) for _ in range(r.randrange(4))]
        text, _ = chat.render(turns)
        assert chat.parse(text) == turns


def test_chat_odd_records(spark):
    deep = '{"prompt":' + "[" * 200_000 + "]" * 200_000 + ',"response":"a"}'
    rows = [(1, '{"prompt":"\\ud800","response":"a"}'), (2, deep), (3, '{"prompt":"p","response":"r"}'), (3, '{"prompt":"p","response":"r"}'), (None, '{"prompt":"p","response":"r"}'), (4, "[]"), (5, '{"a":' * 950 + "1" + "}" * 950)]
    docs = spark.createDataFrame(rows, "id long, j string")
    out = chat.format_records(docs, "id", "j")
    got = [(r["id"], r["formatted"]) for r in out.collect()]
    text = "### user: p </turn>\n### assistant: r </turn>\n"
    assert sorted(got, key=str) == sorted([(1, None), (2, None), (3, text), (3, text), (None, text), (4, None), (5, None)], key=str)
    digests = {r["id"]: r for r in chat.digests(out, "id").collect()}
    assert digests[1]["n_turns"] is None and (digests[3]["n_turns"], digests[3]["loss_chars"]) == (2, 1)
    assert chat.format_records(docs.limit(0), "id", "j").count() == chat.digests(out.limit(0), "id").count() == 0


def test_conversations_take_their_layout(spark):
    turns = [(2, 0, "user", "q"), (2, 1, "assistant", "a"), (3, 1, "assistant", "b"), (3, 0, "human", "x"), (3, None, "system", None), (4, 0, "user", "q"), (4, 1, "user", "r"), (None, 0, "user", "n"), (4, 1, "user", "r")]
    rows = spark.createDataFrame(turns, "conv_id long, turn int, role string, text string")
    out = {r["conv_id"]: r for r in chat.format_records(chat.conversations_as_records(rows), "conv_id", "record").collect()}
    assert {k: v["layout"] for k, v in out.items()} == {2: "prompt", 3: "messages_text", 4: "messages", None: "messages"}
    assert chat.parse(out[3]["formatted"]) == [("system", ""), ("human", "x"), ("assistant", "b")]
    assert chat.parse(out[4]["formatted"]) == [("user", "q"), ("user", "r"), ("user", "r")]
    assert chat.conversations_as_records(rows.limit(0)).count() == 0


def test_url_rules_of_many_paths(spark):
    """A host with very many paths, of which the longest that fits holds; a block before an allow of one path."""
    rules = [("a.org", f"/{i}/{j}", "block" if (i + j) % 2 else "allow") for i in range(100) for j in range(30)] + [("a.org", "/7/7", "block"), ("org", "/7/7/extra/long", "allow")]
    urls = [(k, f"http://w.a.org/{k % 120}/{k % 37}/x") for k in range(2000)] + [(9000, "http://b.a.org/7/7/extra/long")]
    pages = spark.createDataFrame(urls, "page_id long, url string")
    table = spark.createDataFrame(rules, "host string, path string, action string")
    own = {p: a for h, p, a in rules if h == "a.org"} | {"/7/7": "block"}
    want = {}
    for k, u in urls:
        path = u.split(".org", 1)[1]
        best = max((p for p in (path[:n] for n in range(len(path) + 1)) if p in own), key=len, default=None)
        want[k] = own.get(best, "allow")
    want[9000] = "allow"
    for size in (url_rules.BROADCAST_BYTES, 0):
        assert {r["page_id"]: r["verdict"] for r in url_rules.judge(pages, table, broadcast_bytes=size).collect()} == want


def test_keys_that_look_like_paths(spark):
    odd = ['{"messages[].role":"user","messages[].content":"x"}', '{"messages[]":"x"}', '{"conversations[].from":"a","conversations[].value":"b"}', '{"prompt\\nresponse":"x"}', '{"":{"":1}}', '{"messages[]{}":1}', '{"messages":[{"role.content":"x"}]}']
    good = '{"messages":[{"role":"user","content":"hi"}]}'
    rows = spark.createDataFrame([(k, x) for k, x in enumerate([*odd, good])], "id int, record string")
    out = {r["id"]: r for r in chat.format_records(rows, "id", "record").collect()}
    assert all(out[k]["layout"] is None and out[k]["formatted"] is None for k in range(len(odd))) and out[len(odd)]["layout"] == "messages"
    assert len({out[k]["fingerprint"] for k in range(len(odd))}) == len(odd)


def test_large_declared_canvases(spark, monkeypatch):
    small = gif.write_gif(b"x" * 192)
    wide = small[:6] + struct.pack("<HH", 60_000, 60_000) + small[10:]
    at = small.index(b"\x21\xf9\x04") + 8
    frame = small[: at + 5] + struct.pack("<HH", 60_000, 60_000) + small[at + 9 :]
    rows = spark.createDataFrame([(1, bytearray(wide)), (2, bytearray(frame)), (3, bytearray(small))], "id int, gif binary")
    got = {(r["id"], r["frame"]): r["error"] for r in gif.frames(rows, "id").collect()}
    assert got == {(1, 0): "canvas too large", (2, 0): "frame too large", (3, 0): None}
    many = gif.write_gif(bytes(range(192)) * 1000)
    monkeypatch.setattr(gif, "MOST_HELD", 1)
    out = gif.frames(spark.createDataFrame([(4, bytearray(many))], "id int, gif binary"), "id").collect()
    assert [r["frame"] for r in out] == list(range(len(list(gif.read_gif(many)))))
