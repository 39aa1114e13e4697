import re
from collections import defaultdict

from conftest import SF_SMALL
from strivelake.llm import line_dedup as ld

CUT = re.compile(r"(?<=\n)|(?<=[.!?…] )")


def units(text):
    return [u for u in CUT.split(text or "") if u]


def needed(docs):
    """{doc_id: unit positions inside a run of MIN_RUN characters that an earlier place has}"""
    norm = lambda u: u.replace("\n", "").strip(" ")
    first, out = defaultdict(list), {}
    parts = {d: units(t) for d, t in docs}
    for d in sorted(parts):
        mine, hs = parts[d], [norm(u) for u in parts[d]]
        lines = {(e, p - q) for p, h in enumerate(hs) for e, q in first[h]}
        lines |= {(d, p - q) for p, h in enumerate(hs) for q in range(p) if hs[q] == h}
        hit = set()
        for e, shift in lines:
            theirs, run = [norm(u) for u in parts[e]], []
            for p in range(len(hs) + 1):
                if p < len(hs) and 0 <= p - shift < len(theirs) and hs[p] == theirs[p - shift]:
                    run.append(p)
                else:
                    if sum(len(mine[x]) for x in run) >= ld.MIN_RUN:
                        hit.update(run)
                    run = []
        out[d] = hit
        for p, h in enumerate(hs):
            first[h].append((d, p))
    return out


def test_no_long_run_is_missed_and_nothing_new_is_cut(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = {r.doc_id: r for r in ld.dedup_lines(docs, removed_col="runs").collect()}
    want = needed(texts.items())
    seen = set()
    for d in sorted(texts):
        cut = {p for a, b in (got[d].runs or []) for p in range(a, b)}
        parts = units(texts[d])
        assert want[d] <= cut
        assert "".join(u for p, u in enumerate(parts) if p not in cut) == got[d].text
        for p, u in enumerate(parts):
            u = u.replace("\n", "").strip(" ")
            assert p not in cut or u in seen
            seen.add(u)


def test_edges(spark):
    passage = ("The committee met on a cold morning to discuss the harvest. Nobody had slept well. "
               "Reports from the valley were late, and the bridge had not been mended yet. "
               "They agreed to wait for another week before sending the carts out again. ")
    rows = [(1, "Start one. " + passage + "End one."), (2, "Other opening words.\n" + passage + "Other end."),
            (3, None), (4, ""), (5, passage), (5, passage), (6, "Short line.\nShort line.\n"),
            (7, "Short line."), (None, "Null id text stays whole."), (8, passage + "middle part here. " + passage)]
    docs = spark.createDataFrame([(i, t, 1, "k") for i, t in rows], "doc_id long, text string, `__key` int, runs string")
    got = ld.dedup_lines(docs)
    assert got.columns == docs.columns
    by = {}
    for r in got.collect():
        by.setdefault(r.doc_id, []).append(r.text)
    assert by[1] == [rows[0][1]]
    assert by[2] == ["Other opening words.\nOther end."]
    assert by[3] == [None] and by[4] == [""] and by[5] == ["", ""]
    assert by[6] == [rows[6][1]] and by[7] == ["Short line."] and by[None] == ["Null id text stays whole."]
    assert by[8] == ["middle part here. "]
    assert ld.dedup_lines(docs.limit(0)).count() == 0


def test_window_minima(spark):
    df = spark.createDataFrame([([5, 3, 3, 9, 1],), ([7],), ([2, 1],)], "h array<long>")
    got = [sorted(r[0]) for r in df.select(ld.window_minima(df.h, 3)).collect()]
    assert got == [[2, 4], [0], [1]]
    two = [sorted(r[0]) for r in df.select(ld.window_minima(df.h, 2)).collect()]
    assert two == [[1, 2, 4], [0], [1]]


def test_source_is_found_behind_edited_copies(spark):
    run = [f"Sentence number {k} of the passage has its own several words. " for k in range(8)]
    edited = "".join(u if k % 2 else f"Changed line {k} here instead of it. " for k, u in enumerate(run))
    part = "Begin here. " + "".join(run[2:4]) + "Something else follows at this place. "
    rows = [(1, edited), (2, part), (3, "Opening of three. " + "".join(run) + "Close."),
            (4, "Opening of four. " + "".join(run) + "Other close.")]
    got = {r.doc_id: r.text for r in ld.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == dict(rows[:3]) | {4: "Opening of four. Other close."}
    many = "".join(f"w{k}. " for k in range(80))  # windows of many short units
    docs = spark.createDataFrame([(1, many), (2, "Other. " + many + "End.")], "doc_id long, text string")
    assert {r.doc_id: r.text for r in ld.dedup_lines(docs).collect()} == {1: many, 2: "Other. End."}
