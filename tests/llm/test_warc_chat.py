import base64
import hashlib

from conftest import SF

from granary.llm.chat_format import conversation_pairs, op4_preference_format, preference_format
from granary.llm.warc import decode_block, op1_warc, read_warc, reassemble, round_trip, write_warc

ROWS = [(1, "a", None), (2, "b", ""), (3, None, "x\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n"), (4, "q", "é" * 50000), (5, "q\r\nz", "é" * 50000), (None, "n", "é" * 50000), (5, "q\r\nz", "é" * 50000), (7, "u", None)]


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def test_round_trip_of_edges(spark):
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    got = round_trip(df, segment_chars=1000, chunk_chars=300).collect()
    by = {i: (t, to) for i, t, to in [(1, "revisit", 7), (2, "revisit", 7), (3, "response", None), (4, "revisit", 5), (5, "response", None), (None, "revisit", 5), (7, "response", None)]}
    text = {i: t for i, _, t in ROWS}
    assert len(got) == len(ROWS)
    for r in got:
        assert (r.record_type, r.refers_to, r.payload_digest, r.payload_bytes, r.status) == (*by[r.page_id], digest(text[r.page_id]), len((text[r.page_id] or "").encode()), "ok")
    assert round_trip(df.limit(0)).collect() == []
    assert {r.record_type for r in round_trip(df, min_revisit_bytes=1).where("payload_bytes = 0").collect()} == {"response"}


def test_revisits_of_a_whole_table(spark, duck, tmp_path):
    """Every third page twice more, and empty ones: the largest id of equal payloads is the response."""
    rows = [*duck.execute("SELECT page_id, url, html FROM pages").fetchall(), (900_001, "u", None), (900_002, None, "")]
    rows += [(1_000_000 + k * 10_000 + i, u, t) for k in (1, 2) for i, u, t in rows if i % 3 == 0 or i > 900_000]
    spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5).write.parquet(f"{tmp_path}/pages.parquet")
    largest = {}
    for i, _, t in rows:
        largest[t or ""] = max(i, largest.get(t or "", i))
    got = op1_warc(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    text = {i: t or "" for i, _, t in rows}
    for r in got:
        first = largest[text[r.page_id]]
        assert (r.record_type, r.refers_to) == (("response", None) if first == r.page_id else ("revisit", first))
        assert (r.payload_bytes, r.payload_digest, r.status) == (len(text[r.page_id].encode()), digest(text[r.page_id]), "ok")


def test_archives_are_of_bounded_size(spark, tmp_path):
    write_warc(spark.createDataFrame([(i, "u", f"page {i} " * 50) for i in range(25)], "page_id long, url string, html string").coalesce(1), f"{tmp_path}/w", segment_chars=200, file_records=10)
    files = spark.read.format("binaryFile").load(f"{tmp_path}/w").collect()
    from granary.llm.warc import parse_records

    sizes = [len(list(parse_records(bytes(f.content)))) for f in files]
    assert max(sizes) <= 10 and len(sizes) >= 5 and reassemble(read_warc(spark, f"{tmp_path}/w")).where("status = 'ok'").count() == 25


def test_whole_table(spark, duck):
    want = {i: (len(t.encode()), digest(t)) for i, t in duck.execute("SELECT page_id, html FROM pages").fetchall()}
    got = op1_warc(spark, SF).collect()
    assert {r.page_id: (r.payload_bytes, r.payload_digest) for r in got} == want
    assert {r.record_type for r in got} == {"response"}


def test_segments_in_any_order_missing_and_miscounted(spark, tmp_path):
    write_warc(spark.createDataFrame([(1, "u", "abc" * 2000)], "page_id long, url string, html string"), f"{tmp_path}/w", segment_chars=500)
    records = read_warc(spark, f"{tmp_path}/w").orderBy("segment_number", ascending=False).coalesce(1).cache()
    whole = reassemble(records).first()
    assert bytes(whole.payload) == b"abc" * 2000 and whole.status == "ok"
    assert reassemble(records.unionAll(records)).first().status == "ok"
    assert reassemble(records.where("segment_number != 3")).first().status == "incomplete"
    assert reassemble(records.where("total_length is null")).first().status == "incomplete"
    assert reassemble(records.where("segment_number > 1")).first().record_type is None


def test_chunk_framing():
    head = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n"
    assert decode_block(head + b"3;x=y\r\nabc\r\n0\r\n\r\n") == (b"abc", "ok")
    assert decode_block(b"HTTP/1.1 200 OK\r\n\r\nplain") == (b"plain", "ok")
    for bad in (b"5\r\nabc\r\n0\r\n\r\n", b"zz\r\nabc\r\n", b"3\r\nabc\r\n", b"3"):
        assert decode_block(head + bad) == (None, "bad chunk")
    assert decode_block(b"no headers") == (None, "no end of headers")


def test_preference_format_edges(spark):
    rows = [
        (1, "chosen", 0, "user", "hi"), (1, "chosen", 1, "assistant", "a"), (1, "rejected", 0, "user", "hi"), (1, "rejected", 1, "assistant", "bb"), (1, "rejected", 2, "user", "q"), (1, "rejected", 3, "assistant", "cc"),
        (2, "chosen", None, None, None), (3, "rejected", 0, "user", "z"), (None, "chosen", 0, "user", "x"), (None, "rejected", 0, "user", "x"), (4, "other", 0, "user", "x"),
    ]
    df = spark.createDataFrame([(*r, 1) for r in rows], "pair_id long, side string, turn long, role string, text string, TURN int")
    got = {r.pair_id: r for r in preference_format(df).collect()}
    assert set(got) == {1, 2, 3, None}
    one = got[1]
    assert one.n_prompt_turns == 1 and one.prompt == "<|im_start|>user\nhi<|im_end|>\n"
    cut = lambda r, s: [r[s][a:b] for a, b in r[f"{s}_mask"]]
    assert cut(one, "chosen") == ["a<|im_end|>\n"] and cut(one, "rejected") == ["bb<|im_end|>\n", "cc<|im_end|>\n"]
    assert got[None].n_prompt_turns == 1 and got[None].chosen == got[None].rejected == ""
    assert got[3].chosen == "" and got[2].chosen == "<|im_start|>\n<|im_end|>\n"
    assert preference_format(df.limit(0)).collect() == []


def test_conversations_against_brute_force(spark, duck):
    turns = {}
    for c, t, role, text in duck.execute("SELECT conv_id, turn, role, text FROM conversations ORDER BY conv_id, turn").fetchall():
        turns.setdefault(c, []).append((role, text))
    want, masks = {}, {}

    def marks(completion):
        at, out = 0, []
        for role, text in completion:
            begin = at + len(f"<|im_start|>{role}\n")
            at = begin + len(f"{text}<|im_end|>\n")
            out += [f"{begin}-{at}"] if role == "assistant" else []
        return ";".join(out)

    for k in {c // 2 for c in turns}:
        a, b = turns.get(2 * k, []), turns.get(2 * k + 1, [])
        last = lambda x: max((i for i, t in enumerate(x) if t[0] == "assistant"), default=None)
        r = a[: last(a)] + [b[last(b)]] if last(a) is not None and last(b) is not None else b
        n = 0
        while n < min(len(a), len(r)) and a[n] == r[n]:
            n += 1
        show = lambda x: "".join(f"<|im_start|>{role}\n{text}<|im_end|>\n" for role, text in x)
        want[k] = (n, show(a[:n]), show(a[n:]), show(r[n:]))
        masks[k] = [marks(a[n:]), marks(r[n:])]
    rows = op4_preference_format(spark, SF).collect()
    assert {r.pair_id: (r.n_prompt_turns, r.prompt, r.chosen, r.rejected) for r in rows} == want
    assert {r.pair_id: [r.chosen_mask, r.rejected_mask] for r in rows} == masks
    assert conversation_pairs(spark.createDataFrame([(None, 0, "user", "x")], "conv_id long, turn long, role string, text string")).collect() == []


def test_every_turn_is_chosen_once(spark, duck, tmp_path):
    turns = [(c, t, "user" if t % 2 == 0 else "assistant", f"c{c}t{t}.") for c, n in [(0, 5), (1, 6), (2, 3), (5, 4), (-1, 2), (-2, 1), (None, 3)] for t in range(n)]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.pair_id: r for r in op4_preference_format(spark, str(tmp_path)).collect()}
    assert set(got) == {0, 1, 2, -1, None}
    show = lambda c: "".join(f"<|im_start|>{role}\n{text}<|im_end|>\n" for i, _, role, text in turns if i == c)
    for k in (0, 1, 2, -1):
        assert got[k].prompt + got[k].chosen == show(2 * k) and got[k].other_prompt + got[k].other_chosen == show(2 * k + 1)
    assert got[0].rejected == show(0)[len(got[0].prompt) :].split("c0t3.")[0] + "c1t5.<|im_end|>\n"
    assert got[0].other_rejected == show(1)[len(got[0].other_prompt) :].split("c1t5.")[0] + "c0t3.<|im_end|>\n"
    assert got[0].other_n_prompt_turns == 5 and got[0].other_chosen_mask == got[0].other_rejected_mask
    assert (got[None].prompt + got[None].chosen, got[None].rejected, got[None].other_chosen) == (show(None), "", None)
    texts = [t for (t,) in duck.execute("SELECT text FROM conversations").fetchall()]
    whole = "".join(f"{r.prompt}{r.chosen}{r.other_prompt}{r.other_chosen}" for r in op4_preference_format(spark, SF).collect())
    assert sum(map(len, texts)) > 0 and all(t in whole for t in texts) and whole.count("<|im_start|>") == len(texts)
