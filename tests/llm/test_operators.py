"""Small fixtures with nulls, empty and long texts, ties, repeated rows, empty tables and extra columns, against brute force."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter
from math import log10

import numpy as np
import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, source string, score string, label string"


def corpus(seed: int = 5) -> list[tuple]:
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdefghij", k=rng.randint(1, 7))) for _ in range(400)]
    prose = lambda n: " ".join(rng.choices(vocabulary, k=n))
    base = [prose(rng.randint(1, 120)) for _ in range(60)]
    texts = list(base)
    for t in base[:20]:
        words = t.split()
        for _ in range(2):
            w = list(words)
            for _ in range(max(1, len(w) // 20)):
                w[rng.randrange(len(w))] = "changed"
            texts.append(" ".join(w))
    passage = prose(60)
    texts += [f"{prose(30)}\n{passage}\n{prose(20)}" for _ in range(4)]
    texts += [base[0], base[0], "", None, " \n\t", "one", "one", "One", prose(6000), " \x1c lead\x1fing ", "É à\x0bü ß ½ 👍 " * 4]
    return [(i, t, f"s{i % 3}", "x", "y") for i, t in enumerate(texts)] + [(None, base[0], None, "x", "y"), (3, base[3], "s0", "x", "y")]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def shingles(text, k):
    w = (text or "").encode().lower().split()
    return set() if not w else {tuple(w)} if len(w) < k else set(zip(*[w[i:] for i in range(k)], strict=False))


def groups(rows, k, percent=80):
    s = {d: shingles(t, k) for d, t, *_ in rows if d is not None}
    parent = {d: d for d in s}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(s)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(s[a] & s[b])
            if s[a] and s[b] and 100 * both >= percent * (len(s[a]) + len(s[b]) - both):
                p, q = find(a), find(b)
                parent[max(p, q)] = min(p, q)
    return {d: (len(s[d]), find(d)) for d in ids}


# 1


def test_packing(docs, empty, rows):
    from tokenizers import Tokenizer

    from foliant.llm.packing import pack
    from foliant.llm.queries import tokenizer_path

    tok = Tokenizer.from_file(tokenizer_path())
    p = pack(docs, tokenizer_path(), capacity=256).toPandas()
    want = {}
    for d, t, *_ in rows:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 1]
        for k in range(0, len(ids), 256):
            part = ids[k : k + 256]
            want.setdefault((d, k // 256), set()).add((k, len(part), zlib.crc32(np.asarray(part, dtype="<u4").tobytes())))
    got = [((None if np.isnan(r.doc_id) else int(r.doc_id), r.piece), (r.start, r.length, r.ids_crc32)) for r in p.itertuples()]
    assert len(got) == len(rows) + sum(len(v) for k, v in want.items() if k[1]) and all(v in want[k] for k, v in got)
    q = p.sort_values(["sequence_id", "offset"])
    assert (q.groupby("sequence_id").length.cumsum() - q.length == q.offset).all() and q.groupby("sequence_id").length.sum().max() <= 256
    assert q.sequence_id.nunique() <= 1.05 * (p.length.sum() / 256) + 1
    assert pack(empty, tokenizer_path()).count() == 0


def test_encoder_reads_added_tokens():
    from tokenizers import Tokenizer

    from foliant.llm.packing import encoder
    from foliant.llm.queries import tokenizer_path

    tok, encode = Tokenizer.from_file(tokenizer_path()), encoder(tokenizer_path())
    for t in ("a b<|endoftext|>c d", "<|startoftext|>", "x <|ENDOFTEXT|> y", "<|endoftext|", "l'<|endoftext|>'s \x1c x", "", "Plain, words."):
        assert np.frombuffer(encode(t), "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids


def test_plan_uses_every_piece_once():
    from foliant.llm.packing import plan_patterns, slots

    rng = random.Random(1)
    for _ in range(20):
        counts = Counter(rng.randint(1, 100) for _ in range(rng.randint(0, 300)))
        plan = plan_patterns(dict(counts), 100)
        used = Counter()
        for lengths, times in plan:
            assert sum(lengths) <= 100
            used.update({n: times * c for n, c in Counter(lengths).items()})
        assert used == counts and set(slots(plan)) == set(counts)
    assert len(plan_patterns({60: 5, 30: 5, 10: 5, 100: 2}, 100)) == 2
    with pytest.raises(ValueError):
        plan_patterns({101: 1}, 100)


def test_plan_of_two_humps():
    from foliant.llm.packing import plan_patterns

    counts = Counter()
    for n in range(1700, 1901):
        counts.update({n: 10, 700: 20, 4096 - 1400 - n: 10})
    plan = plan_patterns(dict(counts))
    used = Counter()
    for lengths, times in plan:
        assert sum(lengths) <= 4096
        used.update({n: times * k for n, k in Counter(lengths).items()})
    assert used == counts
    assert sum(times for _, times in plan) == 2010  # the bound: each long length with 700 + 700 + the rest


# 2


def test_decontamination(spark, empty):
    from foliant.llm.decontam import drop_leaks, leaks

    items = [(1, "Alice bought 12 kg of apples for 30 dollars and sold 12 kg of pears to Bob Stone."), (2, "the cat sat on the mat while rain fell on the old roof"), (3, "Tiny item"), (4, None), (None, "x y z a b c"), (5, "")]
    b = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit("x"))
    texts = [
        (1, "Intro words. Carol bought 15 kg of apples for 44 dollars and sold 15 kg of pears to Dan Stone. More text follows here."),  # other values
        (2, "Intro words. Carol bought 15 kg of apples for 44 dollars and sold 99 kg of pears to Dan Stone."),  # 12 -> 15 and 99
        (3, "xx THE CAT sat on the mat while rain fell on the old roof!! yy"),
        (4, "the cat sat on a chair while snow fell"), (5, None), (6, ""), (7, "tiny item"), (8, "a tiny item here"), (None, items[1][1]), (9, items[1][1]), (9, items[1][1]),
        (9, "other text that 7 people wrote in 1999 for Bob and is longer than the item by some words so that places differ"),
    ]
    d = spark.createDataFrame(texts, "doc_id long, text string").withColumns({"item_id": F.lit("x"), "key": F.lit(1), "windows": F.lit(2)})
    got = {(r["doc_id"], r["item_id"]) for r in leaks(d, b).collect()}
    assert got == {(1, 1), (3, 2), (7, 3), (9, 2)}
    assert sorted(r["doc_id"] or -1 for r in drop_leaks(d, b).collect()) == [-1, 2, 4, 5, 6, 8]
    assert leaks(empty, b).count() == 0 and leaks(d, b.limit(0)).count() == 0 and drop_leaks(d, b.limit(0)).count() == len(texts)


def test_decontamination_trims_each_word_once_and_makes_keys_in_compiled_code(spark):
    from foliant.llm.decontam import _tokens, _windows, template

    texts = ["Then. Anna paid 12,50. usd to ANNA, (Bob) -- 3 km ß É 'Élan' \U0001d400x \u01c5x ŉ 4", "a Bc", "", " \n", "-- ...", "1 2 3 4 5"]
    raw = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", _tokens(F.col("t")).alias("raw"))
    words = raw.select("i", template(F.col("raw")).alias("words"))
    got = {r["i"]: r["words"] for r in words.collect()}
    assert got[0] == "then anna paid <num> <unit> to anna <name>  <num> <unit> ß É <name> \U0001d400x <name> ŉ <num>".replace("É", "é").split(" ")
    assert got[1] == ["a", "<name>"] and got[2] == [] and got[3] == [] and got[4] == ["", ""] and got[5] == ["<num>"] * 5
    made = _windows(words, "words", 5, "at").select("i", "at", "key")
    places = sorted((r["i"], r["at"]) for r in made.collect())
    assert places == [(0, k) for k in range(len(got[0]) - 4)] + [(1, 0), (4, 0), (5, 0)]
    plan = made._jdf.queryExecution()
    assert plan.optimizedPlan().toString().count("trim(") == 1
    assert ") Generate" in plan.executedPlan().toString()  # within a whole-stage step


def test_decontamination_against_brute_force(spark, sf_dir):
    from foliant.llm.decontam import leaks

    d, b = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    texts, items = d.select("doc_id", "text").collect(), b.collect()
    want = {(x["doc_id"], i["item_id"]) for x in texts for i in items if i["text"] in x["text"]}
    got = {(r["doc_id"], r["item_id"]) for r in leaks(d, b).collect()}
    assert want and got == want


# 3


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates(docs, empty, rows, k):
    from foliant.llm.neardup import near_duplicates

    got = near_duplicates(docs, k=k).collect()
    want = groups(rows, k)
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]] and r["kept"] == (r["doc_id"] == r["component_id"])
    assert near_duplicates(empty, k=k).count() == 0


def test_near_duplicates_of_repeated_ids(spark):
    """Versions of one doc_id hang together and each can extend the component."""
    from foliant.llm.neardup import near_duplicates

    rng = random.Random(3)
    text = lambda: " ".join(f"w{rng.randrange(10**9)}" for _ in range(40))
    a, b, c, e = text(), text(), text(), text()
    rows = [(0, b), (1, a), (1, b), (2, a), (5, c), (6, c + " more"), (6, e), (7, e + " words"), (8, ""), (8, text()), (9, text()), (9, text()), (None, a)]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k=2).collect()
    assert len(got) == len(rows)
    of = {r["doc_id"]: r["component_id"] for r in got if r["n_shingles"]}
    assert of == {0: 0, 1: 0, 2: 0, 5: 5, 6: 5, 7: 5, 8: 8, 9: 9, None: None}
    assert len({(r["doc_id"], r["component_id"]) for r in got if r["doc_id"] in (1, 6, 9)}) == 3


def test_near_duplicates_in_one_large_family(spark, monkeypatch):
    """Many copies around the threshold: hubs alone miss links that the blocks find; hot keys are salted."""
    from foliant.llm import common
    from foliant.llm.neardup import near_duplicates

    monkeypatch.setattr(common, "HOT", 20)

    rng = random.Random(8)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(220):
        w = list(base)
        for _ in range(rng.randint(0, 7)):
            w[rng.randrange(60)] = f"x{rng.randrange(10_000)}"
        rows.append((i, " ".join(w)))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k=2).collect()}
    assert got == groups(rows, 2)


def test_pruning_bound():
    from foliant.llm.neardup import least_matches

    tests = least_matches(0.8, 364, 52, 1e-6)
    rng = np.random.default_rng(0)
    p = 0.8 + 0.2 / 256
    same = rng.random((20_000, 364)) < p
    assert all((same[:, :n].sum(axis=1) >= need).all() for n, need in tests) and tests[-1][1] > 230


# 4


def test_toxicity(spark, empty):
    from foliant.llm.toxicity import fit, pooled, toxicity, words_of

    rng = random.Random(2)
    clean = ["".join(rng.choices("abcdeghiklmnoprstu", k=rng.randint(2, 9))) for _ in range(500)]
    rows, labels = [], []
    for i in range(900):
        w = rng.choices(clean, k=rng.randint(5, 60))
        bad = i % 4 == 0
        if bad:
            for insult in rng.sample(["vuzzok", "quilfad", "zorgwit"], 2):
                w.insert(rng.randrange(len(w)), insult)
        rows.append((i, " ".join(w), "src", i, "1"))
        if i % 9:
            labels.append((i, int(bad), 1))
    labels += [(5, None, 0), (None, 1, 0), (7, 7, 0), (9, 0, 1)]
    rows += [(1000, None, "s", 0, "1"), (1001, "", "s", 0, "1"), (None, "vuzzok quilfad", "s", 0, "1"), (1002, "a v.u.z.z.o.k and qui1fad there", "s", 0, "1")]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string, score long, predicted string")
    l = spark.createDataFrame(labels, "doc_id long, toxic int, quality int")  # noqa: E741
    got = {r["doc_id"]: r for r in toxicity(d, l).collect()}
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got.values())
    held = [i for i in range(900) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i]["held_out"] for i in held) and not got[None]["held_out"]
    assert np.mean([got[i]["predicted"] == (i % 4 == 0) for i in held]) > 0.97
    assert got[1000]["score"] == got[1001]["score"] and got[1002]["predicted"] == 1 and got[None]["predicted"] == 1
    assert toxicity(empty, l).count() == 0
    assert {r["score"] for r in toxicity(d.limit(3), l.limit(0)).collect()} == {0.5}
    m = fit(["ok fine", "vuzzok"] * 20, [0, 1] * 20)
    assert m.landmarks
    del pooled, words_of


def test_kernel_tolerates_insertions():
    from foliant.llm.toxicity import Kernel, pooled, words_of

    k = Kernel(["^idiot$", "^stupid$"])
    top = lambda t: float(pooled(k, [words_of(t)], {}).max())
    assert top("an idiot here") == 1 and top("i d i o t") == 1 and top("1d1ot") == 1 and top("id-iot") == 1
    assert top("idxiot") > 0.5 > top("period of time")
    assert top("x" * 5000 + "stupid" + "y" * 5000) > 0.5


# 5


def test_tool_calls(spark):
    from foliant.llm.chat import format_chat, link_calls

    rows = [
        (1, 0, "system", '{"content":"hi","tools":[{"name":"add","parameters":{"properties":{"a":{"type":"integer"},"b":{"type":"number"}},"required":["a","b"]}}]}'),
        (1, 1, "user", "2+2?"), (1, 2, "tool", '{"tool_call_id":"c1","content":{"z":1,"a":[1,2]}}'),
        (1, 3, "assistant", '{"tool_calls":[{"id":"c1","name":"add","arguments":{"b":2.5,"a":2}},{"id":"c2","name":"add","arguments":{"a":"x","q":1}},{"id":"c3","name":"mul","arguments":{}}]}'),
        (1, 4, "tool", '{"tool_call_id":"c9","content":"lost"}'), (1, 5, "tool", '{"tool_call_id":"c1","content":"again"}'),
        (2, 0, None, None), (2, 1, "assistant", '{"bad json'), (None, 0, "user", 'é "q"\n'), (3, None, "user", "x"), (4, 0, "user", "same"), (4, 0, "user", "same"),
    ]
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"call_id": F.lit(1), "status": F.lit("s")})
    got = {(r["conv_id"], r["call_id"], r["status"]): r for r in link_calls(d).collect()}
    assert got[1, "c1", "linked"]["result_turn"] == 2 and got[1, "c1", "linked"]["problems"] == ""
    assert got[1, "c2", "no_result"]["problems"] == "a is not integer; missing b; unexpected q"
    assert got[1, "c3", "no_result"]["problems"] == "unknown tool" and (1, "c9", "no_call") in got and (1, "c1", "duplicate") in got
    m = format_chat(d).collect()
    assert len(m) == len(rows)
    one = sorted((r for r in m if r["conv_id"] == 1), key=lambda r: (r["order_turn"], r["order_step"], r["turn"]))
    assert [r["turn"] for r in one] == [0, 1, 3, 2, 4, 5] and [r["valid"] for r in one] == [True, True, False, True, False, False]
    assert one[3]["message"] == '{"content":"{\\"a\\":[1,2],\\"z\\":1}","role":"tool","tool_call_id":"c1"}'
    assert '"arguments":{"a":2,"b":2.5}' in one[2]["message"]
    assert format_chat(d.limit(0)).count() == 0


def test_chat_keeps_arguments_and_tools(spark):
    import json

    from foliant.llm.chat import format_chat

    tools = [{"name": "f", "description": "d", "parameters": {"properties": {"p": {"type": "string", "enum": ["x"]}}, "required": ["p"]}}]
    call = json.dumps({"content": "", "tool_calls": [{"id": "a", "name": "f", "arguments": '{"p": "x'}]})
    result = json.dumps({"tool_call_id": "a", "content": "ok"})
    d = [(1, 0, "assistant", call), (1, 1, "tool", result), (2, 0, "system", json.dumps({"content": "s", "tools": tools}))]
    got = {(r["conv_id"], r["turn"]): r for r in format_chat(spark.createDataFrame(d, "conv_id long, turn long, role string, text string")).collect()}
    assert json.loads(got[1, 0]["message"])["tool_calls"][0]["arguments"] == '{"p": "x' and not got[1, 0]["valid"]
    assert json.loads(got[2, 0]["message"])["tools"] == tools and got[2, 0]["valid"]


def test_chat_against_brute_force(spark):
    """Generated conversations: both call forms, odd arguments, lost and repeated ids, calls that name other calls, cycles."""
    import json

    from foliant.llm.chat import format_chat

    rng = random.Random(21)
    rows, want, needs = [], {}, {}
    for conv in range(60):
        ids = [f"id{conv}-{i}" for i in range(rng.randint(0, 5))]
        named = {c: rng.choice(ids) if rng.random() < 0.5 else None for c in ids}
        messages: list[tuple] = [("user", "plain {text", None)]
        for c in ids:
            arguments = {"x": rng.randrange(9), "from": rng.choice(["%s", "$%s", "${%s}", "{{%s}}"]) % named[c] if named[c] else "none", "a": None}
            call = {"id": c, "name": "f", "arguments": arguments, "index": 0}
            if rng.random() < 0.5:
                call = {"type": "function", "id": c, "function": {"name": "f", "arguments": json.dumps(arguments)}}
            content = rng.choice([None, "hm", ""])
            out = {"id": c, "name": "f", "arguments": arguments} | {k: call[k] for k in ("index", "type") if k in call}
            messages.append(("assistant", json.dumps({"tool_calls": [call], "content": content, "mood": [1, {"b": 2, "a": 1}]}), (c, {"content": content, "role": "assistant", "tool_calls": [out], "mood": [1, {"a": 1, "b": 2}]})))
            if rng.random() < 0.9:
                messages.append(("tool", json.dumps({"tool_call_id": c, "content": "ok", "took": 3}), (c, {"content": "ok", "role": "tool", "tool_call_id": c, "took": 3})))
        rng.shuffle(messages)
        calls = {m[2][0]: t for t, m in enumerate(messages) if m[0] == "assistant"}
        results = {m[2][0]: t for t, m in enumerate(messages) if m[0] == "tool"}
        for t, (role, text, made) in enumerate(messages):
            rows.append((conv, t, role, text))
            want[conv, t] = made[1] if made else {"content": text, "role": role}
        needs[conv] = {(calls[c], results[c]) for c in results} | {(results.get(named[c], calls[named[c]]), calls[c]) for c in ids if named[c]}
        needs[conv] = {(a, b) for a, b in needs[conv] if a != b}
    got = format_chat(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert len(got) == len(rows)
    place = {}
    for r in got:
        key = r["conv_id"], r["turn"]
        assert r["message"] == json.dumps(want[key], sort_keys=True, separators=(",", ":"))
        place[key] = (r["order_turn"], r["order_step"], r["turn"]), r["valid"]
    for conv, edges in needs.items():
        reach = {a: {b for x, b in edges if x == a} for a, _ in edges}
        for _ in range(12):
            reach = {a: bs.union(*(reach.get(b, set()) for b in bs)) for a, bs in reach.items()}
        cyclic = {a for a, bs in reach.items() if a in bs}
        behind = cyclic.union(*(reach[a] for a in cyclic), set())
        for a, b in edges:
            if b not in behind:
                assert place[conv, a][0] < place[conv, b][0]
        assert all(not place[conv, a][1] for a in cyclic)
        if not any(a > b for a, b in edges):
            assert all(place[conv, t][0] == (t, 0, t) for c, t in place if c == conv)


# 6


def test_blocks_of_broken_markup():
    from foliant.llm.html_blocks import blocks

    page = "<head><title>T</title></head><body><nav><a href=x>Go</a></nav><p>One <b>two<br>three &amp; &eacute;<p>Four<!-- <p>no</p> --><script>var a='<p>x</p>'</script><ul><li>a<li>b</ul><p hidden>h</p><textarea>t</textarea>end"
    assert [b.text for b in blocks(page)] == ["Go", "One two three & é", "Four", "a", "b", "h", "end"]
    assert blocks("") == [] and blocks(None) == [] and [b.text for b in blocks("plain  text")] == ["plain text"]
    assert [b.text for b in blocks("<p>a <b c='x>y'>b</b> < c")] == ["a b < c"]


def test_extraction_of_held_out_layouts(spark):
    from foliant.llm.html_blocks import Features
    from foliant.llm.html_extract import extract, labelled, logits, padded, train

    p = train()
    rng, features, right, total = np.random.default_rng(12345), Features(), 0, 0
    for _ in range(150):
        b, y = labelled(rng)
        if b:
            x, mask = padded([features.rows(b)])
            right += int(((logits(p, x, mask)[:, 0] > 0) == (y > 0)).sum())
            total += len(y)
    assert right / total > 0.985
    page = "<html><body><nav><ul><li><a href='/a'>Home</a></li></ul></nav><div class='ad'>Buy now</div><article><h1>Head line</h1><p>First paragraph of text, long enough to be one.</p><p>Second &amp; last paragraph of the text.</p></article><section class='comments'><div class='comment'><p>Nice post, thanks.</p></div></section><footer>&copy; us</footer></body></html>"
    d = spark.createDataFrame([(1, "u", page, "x"), (2, "u", None, "x"), (3, None, "", "x"), (1, "u", page, "x")], "page_id long, url string, html string, text string")
    got = extract(d, p).orderBy("page_id").collect()
    odd = [
        page.replace("<p>First", "<p title='the hidden story of x'>First"), page.replace("<article>", "<article class='post hidden md:block'>"),
        page.replace("First paragraph", "<math><mi>First</mi></math> <noscript>paragraph</noscript>"), page.replace("<p>First", "<p data-state=hidden>First"),
    ]
    for r in extract(spark.createDataFrame([(i, x) for i, x in enumerate(odd)], "page_id long, html string"), p).collect():
        assert r["text"] == "Head line\nFirst paragraph of text, long enough to be one.\nSecond & last paragraph of the text."
    assert [r["text"] for r in got] == ["Head line\nFirst paragraph of text, long enough to be one.\nSecond & last paragraph of the text."] * 2 + ["", ""]
    assert [r["n_chars"] for r in got] == [len(r["text"]) for r in got] and extract(d.limit(0), p).count() == 0


# 7


def test_repeated_passages(docs, empty, rows):
    from foliant.llm.substring import repeated_passages

    got = repeated_passages(docs).collect()
    words = {d: (t or "").encode().lower().split() for d, t, *_ in rows if d is not None}
    windows: dict[tuple, set] = {}
    for d, w in words.items():
        for j in range(len(w) - 49):
            windows.setdefault(tuple(w[j : j + 50]), set()).add(d)
    need = {d for s in windows.values() for d in s if d != min(s)}
    assert need and need <= {r["doc_id"] for r in got}
    for r in got:
        a, b = words[r["doc_id"]][r["start"] : r["end"]], words[r["other_id"]][r["other_start"] : r["other_end"]]
        assert min(len(a), len(b)) >= 50 and r["other_id"] < r["doc_id"]
        assert sum((Counter(a) & Counter(b)).values()) >= r["matched"] >= 0.8 * max(len(a), len(b))
    assert repeated_passages(empty).count() == 0


def test_passages_around_differing_text(spark):
    from foliant.llm.substring import repeated_passages

    rng = random.Random(7)
    text = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    p, q = text(60), text(60)
    d = [(1, text(30) + p + text(100) + q + text(30)), (2, text(5) + p + text(100) + q), (3, text(9) + q + text(400) + p)]
    got = repeated_passages(spark.createDataFrame([(i, " ".join(w)) for i, w in d], "doc_id long, text string")).collect()
    found = {(r["doc_id"], r["start"], r["end"], r["other_id"], r["other_start"], r["other_end"], r["matched"]) for r in got}
    assert found == {(2, 5, 65, 1, 30, 90, 60), (2, 165, 225, 1, 190, 250, 60), (3, 9, 69, 1, 190, 250, 60), (3, 469, 529, 1, 30, 90, 60)}


def test_passages_whose_seeds_begin_elsewhere(spark):
    from foliant.llm.substring import repeated_passages

    rng = random.Random(8)
    text = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    p, q = text(60), text(60)
    d = [(1, p[:40] + text(20)), (2, text(20) + p[24:]), (3, text(7) + p + text(9)), (4, text(30) + p), (5, text(10) + p[:40] + text(5)), (6, text(3) + p[24:]), (7, p)]
    d += [(11, q), (12, q + text(30) + q)]
    got = repeated_passages(spark.createDataFrame([(i, " ".join(w)) for i, w in d], "doc_id long, text string")).collect()
    found = {(r["doc_id"], r["start"], r["end"], r["other_id"], r["other_start"], r["other_end"], r["matched"]) for r in got}
    assert found == {(4, 30, 90, 3, 7, 67, 60), (7, 0, 60, 3, 7, 67, 60), (12, 0, 60, 11, 0, 60, 60), (12, 90, 150, 11, 0, 60, 60)}


def test_passages_of_repeated_ids(spark):
    """Versions of one doc_id: each keeps its own places, and they aren't compared with each other."""
    from foliant.llm.substring import repeated_passages

    rng = random.Random(9)
    text = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    p, q = text(60), text(60)
    d = [(1, p), (2, ["zz"] * 300 + p), (2, ["zzz", "short"]), (2, text(3) + q), (3, q + text(5)), (3, text(4) + q), (3, q + text(5))]
    got = repeated_passages(spark.createDataFrame([(i, " ".join(w)) for i, w in d], "doc_id long, text string")).collect()
    found = {(r["doc_id"], r["start"], r["end"], r["other_id"], r["other_start"], r["other_end"], r["matched"]) for r in got}
    assert found == {(2, 300, 360, 1, 0, 60, 60), (3, 0, 60, 2, 3, 63, 60), (3, 4, 64, 2, 3, 63, 60)}


def test_fuzzy_passages_are_found(spark):
    """Every tenth word differs: no run of ten equal words, identity of 0.9."""
    from foliant.llm.substring import repeated_passages

    rng = random.Random(10)
    text = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    rows, found = [], 0
    for i in range(60):
        p = text(300)
        other = [w if j % 10 else f"x{i}-{j}" for j, w in enumerate(p)]
        rows += [(2 * i, " ".join(text(20) + p)), (2 * i + 1, " ".join(other + text(20)))]
    got = repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r["doc_id"] == r["other_id"] + 1 and r["other_id"] % 2 == 0 and r["matched"] >= 0.85 * (r["end"] - r["start"]) for r in got)
    found = len({r["doc_id"] for r in got if r["end"] - r["start"] > 250})
    assert found >= 45  # recall of 0.85 was measured


def test_passages_of_one_seed_are_found(spark):
    """27 equal words in a row are sure to give a seed; with every sixth of the other 36 words changed there may be no second one."""
    from foliant.llm.substring import K, minimisers, repeated_passages, word_hashes

    rng = random.Random(12)
    text = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    rows, alone = [], 0
    for i in range(60):
        p = text(63)
        other = [w if 18 <= j < 45 or j % 6 else f"x{i}-{j}" for j, w in enumerate(p)]
        other[17], other[45] = f"y{i}", f"z{i}"
        one, two = " ".join(text(20) + p), " ".join(other + text(20))
        rows += [(2 * i, one), (2 * i + 1, two)]
        alone += len(set(minimisers(word_hashes(one, {}))[0].tolist()) & set(minimisers(word_hashes(two, {}))[0].tolist())) == 1
    got = repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert K == 8 and alone >= 5
    assert {(r["doc_id"], r["other_id"]) for r in got} == {(2 * i + 1, 2 * i) for i in range(60)}


def test_chains_against_all_subsets():
    from foliant.llm.substring import _common, chains

    rng = random.Random(4)
    for _ in range(60):
        n = rng.randint(1, 7)
        pts = sorted({(rng.randrange(60), rng.randrange(60)) for _ in range(n)})
        x, y = [p[0] for p in pts], [p[1] for p in pts]
        value = lambda c: 12 * len(c) - 0.05 * sum(x[b] - x[a] + y[b] - y[a] for a, b in zip(c, c[1:], strict=False))
        subsets = [[i for i in range(len(pts)) if m >> i & 1] for m in range(1, 1 << len(pts))]
        best = max(value(c) for c in subsets if all(x[a] < x[b] and y[a] < y[b] for a, b in zip(c, c[1:], strict=False)))
        assert abs(value(chains(x, y, 12)[0]) - best) < 1e-9
    assert _common([1, 2, 3, 4], [2, 9, 4]) == 2 and _common([], [1]) == 0


# 8


def test_language_model(docs, empty, rows):
    from foliant.llm.lm import scores, tokens

    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 5 == 1
    got = scores(docs, F.crc32(F.col("doc_id").cast("string")) % 5 == 1).collect()
    c = Counter()
    for d, t, *_ in rows:
        if not held(d):
            c.update(tokens(t))
            c["end"] += 1
    n, v = sum(c.values()), len(c)
    assert len(got) == len(rows)
    by = {d: t for d, t, *_ in rows}
    for r in got:
        w = [*tokens(by[r["doc_id"]]), "end"]
        base = sum(log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)
        assert r["train_tokens"] == n and r["n_tokens"] == len(w) and r["n_known"] == sum(c[x] > 0 for x in w)
        assert abs(base - r["base_score"]) < 1e-6 * max(1, abs(base)) and r["held_out"] == held(r["doc_id"]) and r["score"] < 0
    assert scores(empty, F.lit(False)).count() == 0
    assert all(r["n_known"] == 0 and r["train_tokens"] == 0 for r in scores(docs.limit(5), F.lit(True)).collect())


def test_language_model_scores_do_not_depend_on_partitions(spark, sf_dir):
    from foliant.llm.lm import scores

    d = spark.read.parquet(f"{sf_dir}/documents.parquet")
    one, two = ({r["doc_id"]: (r["score"], r["base_score"], r["n_tokens"], r["held_out"]) for r in scores(x, F.crc32(F.col("doc_id").cast("string")) % 5 == 1).collect()} for x in (d, d.repartition(3)))
    assert one.keys() == two.keys() and max(abs(one[k][0] - two[k][0]) / max(1, abs(one[k][0])) for k in one) < 1e-6
    held = [v for v in one.values() if v[3]]
    assert sum(v[0] for v in held) > sum(v[1] for v in held)


def test_class_probabilities_sum_to_one():
    from foliant.llm.lm import WIDTH, Scorer

    p = np.random.default_rng(0).normal(size=(40, 3 * WIDTH + 1)).astype(np.float32)
    s = Scorer(p, {})
    w = np.arange(40, dtype=np.int32)
    for a, b in ((0, 0), (3, 39)):
        total = (10 ** s.log10(np.full(40, a, np.int32), np.full(40, b, np.int32), w)).sum()
        assert abs(total - 1) < 1e-4


# 9


def test_line_dedup(spark):
    from foliant.llm.lines import drop_lines

    rows = [(i, f"common line\nown {i}\n\ncommon line" if i % 2 else f"own {i}", "a", "x") for i in range(20)]
    rows += [(100, "common line", "b", "x"), (101, None, "a", "x"), (102, "", None, "x"), (103, "common line", "a", "x"), (103, "common line", "a", "x")]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string, n_lines string")
    got = drop_lines(d, ratio=0.2, least_pages=3).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    assert by[1]["text"] == "own 1\n" and (by[1]["n_lines"], by[1]["n_dropped"]) == (4, 2)
    assert by[0]["text"] == "own 0" and by[100]["text"] == "common line" and by[101]["text"] is None and by[102]["text"] == "" and by[103]["text"] == ""
    assert drop_lines(d.limit(0)).count() == 0


# 10


def test_media_round_trip(docs, rows, empty):
    from foliant.llm.media import decode, digests, encode, payload_of, store, tensors

    stored = store(docs)
    got = digests(stored).collect()
    by = {d: t for d, t, *_ in rows}
    assert len(got) == len(rows)
    for r in got:
        raw = (by[r["doc_id"]] or "").encode()
        payload = raw + b"\0" * (-len(raw) % 64 if raw else 64)
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"]) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest())
        assert r["tail_crc32"] == zlib.crc32(payload[-64:])
    t = tensors(stored).where("doc_id = 2").first()
    assert len(t["rgb"]) == t["height"] * t["width"] * 3
    assert digests(store(empty)).count() == 0
    for n in (1, 5, 6, 7, 24571):
        data = np.random.default_rng(n).integers(0, 256, 64 * n, dtype=np.uint8).tobytes()
        assert payload_of(decode(encode(data))) == data
    with pytest.raises(ValueError):
        encode(b"short")


def test_decoder_reads_general_scans():
    """Runs of zeros, small values, ended bands and new coefficients in refinements, from a plain bit-by-bit writer."""
    from foliant.llm.media import HEAD, _ended, _scan, _segment, _table, decode

    rng = np.random.default_rng(3)
    n = 12
    coef = np.zeros((n, 64), dtype=np.int64)
    coef[:, 0] = rng.integers(-60, 60, n)
    for b in range(n):
        for k in rng.choice(np.arange(1, 64), rng.integers(0, 20), replace=False):
            coef[b, k] = rng.integers(-15, 16)
    codes = {s: f"{i:08b}" for i, s in enumerate([r << 4 | z for r in range(16) for z in range(11)])}
    table = lambda kind: _table(kind, 0, {8: list(codes)})
    size = lambda v: int(abs(v)).bit_length()
    value = lambda v: f"{(v if v > 0 else v + (1 << size(v)) - 1):0{size(v)}b}" if v else ""
    cut = lambda v, low: int(np.sign(v)) * (abs(int(v)) >> low)

    dc, last = "", 0
    for b in range(n):
        d = int(coef[b, 0] >> 1) - last
        last += d
        dc += codes[size(d)] + value(d)
    first = ""
    for b in range(n):
        run = 0
        for k in range(1, 64):
            v = cut(coef[b, k], 1)
            if v == 0:
                run += 1
                continue
            while run > 15:
                first += codes[0xF0]
                run -= 16
            first += codes[run << 4 | size(v)] + value(v)
            run = 0
        if run:
            first += codes[0]
    again = ""
    for b in range(n):
        new = [k for k in range(1, 64) if abs(coef[b, k]) == 1]
        k, run, held = 1, 0, ""
        for k in range(1, 64):
            v = int(coef[b, k])
            if abs(v) > 1:
                held += str(abs(v) & 1)
                continue
            if v == 0:
                run += 1
                if run == 16 and any(x > k for x in new):
                    again += codes[0xF0] + held
                    run, held = 0, ""
                continue
            again += codes[run << 4 | 1] + ("1" if v > 0 else "0") + held
            run, held = 0, ""
        if run or held:
            again += codes[0] + held
    bits = lambda t: np.frombuffer(t.encode(), np.uint8) - 48
    frame = bytes([8, 0, 24, 0, 32, 1, 1, 0x11, 0])
    one = [(1, 0, 0)]
    low = (coef[:, 0] & 1).astype(np.uint8)
    data = HEAD + _segment(0xC2, frame) + table(0) + table(1) + _scan(one, 0, 0, 0, 1, bits(dc)) + _scan(one, 1, 63, 0, 1, bits(first)) + _scan(one, 0, 0, 1, 0, low) + _scan(one, 1, 63, 1, 0, bits(again)) + b"\xff\xd9"
    pic = decode(data)
    assert (pic.parts[0].coef == coef).all() and pic.rgb().shape == (24, 32, 3)
    assert sum(r for _, r in _ended(70_000)) == 70_000
