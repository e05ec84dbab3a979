"""Archives and quotations (operators 7 and 8)."""

import duckdb
import pytest
from helpers import SF

from cohortlens.llm import arc_warc, quote_links, registry, storage

registry.load_all()


@pytest.mark.parametrize("name,table,key", [("op7_arc_to_warc", "pages", ["page_id"]), ("op8_quote_links", "conversations", ["conv_id", "turn"])])
def test_against_sql(spark, name, table, key):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    want = con.execute(registry.ORACLES[name]).df().sort_values(key).reset_index(drop=True)
    got = registry.QUERIES[name](spark, SF).toPandas().sort_values(key).reset_index(drop=True)
    assert sorted(got.columns) == sorted(want.columns) and len(got) == len(want)
    for c in want.columns:
        assert (got[c].fillna(-1) == want[c].fillna(-1)).all(), c


def test_op7_edges(spark):
    rows = [(1, "http://a b/é#x", "<p>é"), (2, None, None), (3, "u", "<p>é"), (4, "u", ""), (None, "z", "<p>é"), (5, "u", "x\r\n\r\ny\n"),
            (5, "u", "x\r\n\r\ny\n"), (6, "", "x\r\n\r\ny\n"), (7, "long", "ab" * 200000)]
    pages = spark.createDataFrame([(*r, "f") for r in rows], "page_id long, url string, html string, file string").repartition(3)
    got = arc_warc.archive_digests(pages, storage.work_folder(spark, "t")).collect()
    assert sorted((r.page_id or 0, r.record_type, r.refers_to) for r in got) == [
        (0, "response", None), (1, "response", None), (2, "response", None), (3, "revisit", 1), (4, "revisit", 2), (5, "response", None),
        (5, "response", None), (6, "revisit", 5), (7, "response", None)]
    assert {r.page_id: r.payload_bytes for r in got}[7] == 400000
    assert {r.page_id: r.target_uri for r in got}[2] == "urn:page:2"
    assert arc_warc.archive_digests(pages.limit(0), storage.work_folder(spark, "t")).count() == 0
    least = arc_warc.archive_digests(pages, storage.work_folder(spark, "t"), least=6).collect()
    assert {r.page_id for r in least if r.record_type == "revisit"} == {6}


@pytest.mark.parametrize("version", [1, 2])
def test_arc_round_trip(version):
    payloads = [b"", b"\n\nWARC/1.1\r\n", "é".encode() * 70000]
    parts = [arc_warc.arc_version_block(version, "f", "19960101000000")]
    parts += [arc_warc.arc_record(version, f"http://x/{i}", "20010203040506", p, 0, "f") for i, p in enumerate(payloads)]
    records = arc_warc.read_file(b"".join(map(arc_warc._member, parts)), "arc")
    assert [arc_warc.split_http(body)[1] for _, body in records] == payloads
    fields, body = records[2]
    fields["URL"] += "#page=2"
    (head, block), = arc_warc.read_file(arc_warc._member(arc_warc.to_warc(fields, body, None)))
    assert head["WARC-Date"] == "2001-02-03T04:05:06Z" and block == body and head["WARC-Type"] == "response"
    with pytest.raises(ValueError):
        arc_warc.read_file(arc_warc._member(b"".join(parts)[:-1]), "arc")


def test_op8_edges(spark):
    rows = [(1, 0, "a", "hello there\nsecond line\n\nlast para"), (1, 1, "b", "On x, a wrote:\n> hello there\n> second line\nmy answer"),
            (1, 2, "a", ">> hello there\n> My   Answer\nok"), (1, 3, "a", "> nothing like it\nq"), (2, 0, "z", "> last para\nfrom elsewhere"),
            (None, 0, "n", "x"), (1, None, "n", "> x"), (3, 0, None, None), (1, 5000, "b", "> ok\n> unknown tail\nlate"), (1, 5000, "b", "dup")]
    df = spark.createDataFrame([(*r, "h") for r in rows], "conv_id long, turn long, role string, text string, hash string")
    got = {(r.conv_id, r.turn, r.body): r for r in quote_links.link_quotes(df, storage.work_folder(spark, "t")).collect()}
    assert len(got) == len(rows)
    reply = lambda *k: (got[k].reply_conv, got[k].reply_turn, got[k].position)
    assert reply(1, 1, "my answer") == (1, 0, 2)
    assert reply(1, 2, "ok") == (1, 1, 3)
    assert reply(1, 3, "q") == (None, None, 4)
    assert reply(2, 0, "from elsewhere") == (1, 0, 1)
    assert reply(1, 5000, "late") == (1, 2, 6) and reply(1, 5000, "dup")[2] == 5
    assert got[1, 2, "ok"].max_level == 2 and reply(None, 0, "x") == (None, None, None) and reply(3, 0, "") == (None, None, 1)
    assert quote_links.link_quotes(df.limit(0), storage.work_folder(spark, "t")).count() == 0


def test_op8_original_of_another_thread(spark):
    """The quote's own thread holds the passage first by order, but later than the quote: another thread's original is found."""
    rows = [(1, 0, "> said it so\n\nwhat?"), (1, 5, "said it so"), (2, 0, "said it so")]
    rows += [(t, 0, "said it so") for t in range(3, 60)]
    rows += [(70, 0, "> only here\n\nhm"), (70, 4, "only here")]
    mail = spark.createDataFrame([(t, n, "user", x) for t, n, x in rows], "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.turn): (r.reply_conv, r.reply_turn) for r in quote_links.link_quotes(mail, storage.work_folder(spark, "t")).collect()}
    assert got[(1, 0)] == (2, 0) and got[(70, 0)] == (None, None) and got[(1, 5)] == (None, None)
