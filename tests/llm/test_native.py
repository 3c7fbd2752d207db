"""Edge cases of the operators that use DataFrame operations only, against plain Python."""

import random
import re

from furrow.llm import chat, decontam, lines

DOC = "doc_id long, source string, text string, n_lines int, host string"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def brute_lines(rows, ratio, least):
    drops = {}
    for host in {r[1] for r in rows}:
        texts = {r[2] for r in rows if r[1] == host and r[2] is not None}
        keys = [{x.strip(lines.BLANK) for x in t.split("\n")} - {""} for t in texts]
        drops[host] = {k for s in keys for k in s if (n := sum(k in z for z in keys)) >= least and n > ratio * len(texts)}
    return sorted(
        (str(i), None if t is None else "\n".join(x for x in t.split("\n") if x.strip(lines.BLANK) not in drops[h]), 0 if t is None else t.count("\n") + 1)
        for i, h, t, *_ in rows
    )


def test_lines(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice(["a", "b", None]), "\n".join(rng.choice(["x", " x\r", "menu", "", "é", f"own {i}", f"s{rng.randint(0, 9)}"]) for _ in range(rng.randint(0, 9))), 7, "h") for i in range(120)]
    rows += [(500, "a", None, 7, "h"), (501, "a", "", 7, "h"), (None, "b", "menu\nmine", 7, "h"), (502, "one", "x\ny", 7, "h"), (502, "one", "x\ny", 7, "h")]
    rows += [(600 + i, "b", "copied\npage", 7, "h") for i in range(60)]  # equal pages of a site count once
    rows += [(700, "a", "w " * 200_000 + "\nmenu", 7, "h")]
    for ratio, least in ((0.02, 5), (0.3, 1)):
        got = lines.drop_boilerplate(spark.createDataFrame(rows, DOC), ratio, least)
        assert got.columns == ["doc_id", "source", "text", "host", "n_lines", "n_dropped"]
        out = got.collect()
        assert sorted((str(r.doc_id), r.text, r.n_lines) for r in out) == brute_lines(rows, ratio, least)
        assert all(r.n_dropped == (r.n_lines - (r.text.count("\n") + 1 if r.text else 0) if r.text else r.n_dropped) for r in out)
    assert "Python" not in plan(got)
    assert lines.drop_boilerplate(spark.createDataFrame([], DOC)).collect() == []


def test_hot_page_copies_keep_their_lines(spark):
    rows = [(i, "a", "the same page\nwith two lines", 0, "") for i in range(50)] + [(50 + i, "a", f"own {i}\nfooter", 0, "") for i in range(50)]
    got = {r.doc_id: r.text for r in lines.drop_boilerplate(spark.createDataFrame(rows, DOC)).collect()}
    assert got[0] == "the same page\nwith two lines" and got[50] == "own 0"


CHAT = "conv_id long, turn long, role string, text string, h int"


def test_chat(spark):
    t = lambda c, *texts: [(c, i, "user" if i % 2 == 0 else "bot", x, 1) for i, x in enumerate(texts)]
    rows = t(1, "a", "b") + t(2, "a", "b", "c") + t(3, "a", "x") + t(4, "a", "b", "c") + t(5, "b") + t(6, None) + t(7, "") + t(8, "a <|im_end|>") + t(9, "a")
    rows += t(3, "a", "x")  # repeated whole
    rows += [(None, 0, "user", "q", 1), (10, None, None, "n", 1), (10, 0, "user", "m", 1), (11, 0, "user", "tie", 1), (11, 0, "user", "tie2", 1)]
    got = {r.conv_id: (r.n_turns, r.text) for r in chat.render_chats(spark.createDataFrame(rows, CHAT)).collect()}
    one = lambda role, text: f"<|im_start|>{role}\n{text}<|im_end|>\n"
    assert set(got) == {2, 3, 5, 6, 7, 8, None, 10, 11}
    assert got[2] == (3, one("user", "a") + one("bot", "b") + one("user", "c"))
    assert got[3][0] == 2 and got[6][1] == one("user", "") and got[8][1] == one("user", "a < |im_end|>")
    assert got[10][1] == one("unknown", "n") + one("user", "m") and got[11][0] == 2
    assert chat.render_chats(spark.createDataFrame([], CHAT)).collect() == []
    assert "Python" not in plan(chat.prefixes(spark.createDataFrame(rows, CHAT)))


def test_chat_snapshots_against_brute_force(spark):
    rng = random.Random(8)
    convs = {c: [rng.choice("ab") for _ in range(rng.randint(1, 6))] for c in range(150)}
    rows = [(c, i, "user", x, 0) for c, xs in convs.items() for i, x in enumerate(xs)]
    want = {c for c, x in convs.items() if not any((len(y) > len(x) and y[: len(x)] == x) or (y == x and d < c) for d, y in convs.items())}
    assert {r.conv_id for r in chat.render_chats(spark.createDataFrame(rows, CHAT)).collect()} == want


def test_long_conversations_are_hashed_in_segments(spark):
    rng = random.Random(9)
    long_ = [rng.choice("abc") for _ in range(1000)]
    convs = {1: long_, 2: long_[:999], 3: long_[:64], 4: [*long_[:500], "z", *long_[501:]], 5: long_[:1000], 6: long_[1:], None: long_[:700]}
    rows = [(c, i, "user", x, 0) for c, xs in convs.items() for i, x in enumerate(xs)]
    df = spark.createDataFrame(rows, CHAT)
    found = {n: sorted((str(r.conv_id), r.pos, r.a, r.b) for r in chat.prefixes(df, n).collect()) for n in (1 << 16, 64, 7)}
    assert found[64] == found[7] == found[1 << 16] and len(found[64]) == len(rows)
    at = {(c, p): (a, b) for c, p, a, b in found[64]}
    assert len({at["1", p] for p in range(1, 1001)}) == 1000
    assert all(at["1", p] == at[c, p] for c, m in (("2", 999), ("3", 64), ("4", 500), ("None", 700)) for p in range(1, m + 1))
    assert at["1", 501] != at["4", 501] and at["1", 999] != at["6", 999]
    assert {r.conv_id for r in chat.render_chats(df).collect()} == {1, 4, 6}


def brute_contained(docs, items, width=5, threshold=0.8):
    norm = lambda t: [w for w in re.split("[ \t-\r]+", (t or "").lower()) if w]
    out = {}
    for i, t in items:
        w = norm(t)
        m = min(width, len(w))
        if not m:
            continue
        sh = {tuple(w[k : k + m]) for k in range(len(w) - m + 1)}
        for d, x in docs:
            y = norm(x)
            n = len(sh & {tuple(y[k : k + m]) for k in range(len(y) - m + 1)})
            if n >= threshold * len(sh) - 1e-9:
                out[d, i] = max(out.get((d, i), (0, 0)), (n / len(sh), n))
    return {k: v[1] for k, v in out.items()}


def test_decontamination(spark):
    rng = random.Random(6)
    vocab = [f"W{i}" for i in range(60)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randint(5, 60)))) for i in range(25)]
    items += [(90, "just three words"), (91, "One"), (92, ""), (93, None), (94, "a b a b a b a b a b"), (95, " \n ")]
    docs = []
    for d in range(80):
        w = [rng.choice(vocab) for _ in range(rng.randint(0, 80))]
        if d % 2:
            x = rng.choice(items[:25])[1].split()
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                x[rng.randrange(len(x))] = "edit"
            w[rng.randint(0, len(w)) : 0] = x
        docs.append((d, "  ".join(w).lower() if d % 3 else "\n".join(w)))
    docs += [(200, None), (201, ""), (202, "see JUST three\twords here"), (203, "just three"), (204, "one"), (205, "b a b a b a b a"), (206, "filler " * 50_000 + items[3][1])]
    docs += [(207, items[2][1]), (207, items[2][1]), (207, "other text")]
    df = spark.createDataFrame([(d, t, 1, "h") for d, t in docs], "doc_id long, text string, item_id int, h string")
    it = spark.createDataFrame([(i, t, 5) for i, t in items], "item_id long, text string, n int")
    for width in (5, 3):
        found = decontam.contained_items(df, it, width)
        got = {(r.doc_id, r.item_id): r.n_found for r in found.collect()}
        assert got == brute_contained(docs, items, width)
    assert len(got) > 20 and "Python" not in plan(found)
    left = decontam.remove_contaminated(df, it)
    bad = {t for d, t in docs if any(k[0] == 0 for k in brute_contained([(0, t)], items))}
    assert left.columns == df.columns
    assert sorted((r.doc_id, str(r.text)) for r in left.collect()) == sorted((d, str(t)) for d, t in docs if t not in bad)


def test_decontamination_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    assert decontam.contained_items(none, items).collect() == []
    assert decontam.contained_items(docs, items.limit(0)).collect() == []
    assert decontam.remove_contaminated(docs, items.limit(0)).count() == 1
