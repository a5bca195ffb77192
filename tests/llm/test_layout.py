"""Sharding, chat formatting, rollups, packing, decontamination and the pipeline."""

import base64
import collections
import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
import oracle
from asofstore.llm import chat, common, decontaminate, packing, queries, rollups, sharding
from asofstore.llm.queries import QUERIES, WORD_TOKENIZER
from asofstore.session import scratch_dir
from conftest import SF_SMALL
from llm_cases import no_docs, odd_docs  # noqa: F401


def table(spark, name):
    return common.read(spark, SF_SMALL, name).collect()


# -------------------------------------------------------------------- sharding

def exact_shards(rows, shards):
    """rows: (hash, id, size) in order; shard of each by the bytes before it."""
    total, before, out = sum(s for *_, s in rows), 0, []
    last = None
    for h, i, s in rows:
        if (h, i) != last:
            at, last = before, (h, i)
        out.append(at * shards // total)
        before += s
    return out


def check_shards(docs, got, shards):
    rows = sorted((r["_h"], r["doc_id"] if r["doc_id"] is not None else -2 ** 63, r["size"], r["shard"], r["slot"])
                  for r in got)
    assert [r[3] for r in rows] == exact_shards([r[:3] for r in rows], shards)
    for s in {r[3] for r in rows}:
        assert sorted(r[4] for r in rows if r[3] == s) == list(range(sum(r[3] == s for r in rows)))


def test_sharding_query_is_exact(spark):
    text = {r.doc_id: r.text or "" for r in table(spark, "documents")}
    got = QUERIES["op4_histogram_sort_shards"](spark, SF_SMALL).withColumn("_h", F.lit(0)).collect()
    h = {r.doc_id: r.h for r in common.read(spark, SF_SMALL, "documents").select(
        "doc_id", F.xxhash64("text").alias("h")).collect()}
    assert {r.doc_id for r in got} == set(text)
    assert all(r["size"] == len(text[r.doc_id].encode()) + 8 and r.text_crc32 == zlib.crc32(text[r.doc_id].encode())
               and r.law == "bytes" and r.grown_shard is None for r in got)
    check_shards(None, [r.asDict() | {"_h": h[r.doc_id]} for r in got], 24)


def test_sharding_splits_a_hot_group(spark):
    df = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot text").otherwise(
        F.concat(F.lit("t"), F.repeat(F.col("id").cast("string"), F.pmod(F.hash("id"), F.lit(30))))).alias("text"))
    got = sharding.shard_by_bytes(df, shards=7).withColumn("_h", F.xxhash64("text")).collect()
    check_shards(df, [r.asDict() for r in got], 7)
    loose = sharding.shard_by_bytes(df, shards=7, tolerance=0.05).groupBy("shard").agg(F.sum("size").alias("b")).collect()
    mean = sum(r.b for r in loose) / 7
    assert len(loose) == 7 and max(abs(r.b - mean) for r in loose) <= 0.11 * mean


def test_sharding_odd_rows(spark, odd_docs, no_docs):
    got = sharding.shard_by_bytes(odd_docs, shards=3)
    assert got.columns == [c for c in odd_docs.columns if c not in ("size", "shard")] + ["size", "shard", "slot"]
    check_shards(odd_docs, [r.asDict() for r in got.withColumn("_h", F.xxhash64("text")).collect()], 3)
    assert {r["size"] for r in got.where("text IS NULL OR text = ''").collect()} == {8}
    assert sharding.shard_by_bytes(no_docs, shards=3).count() == 0


def test_shards_as_files(spark, odd_docs):
    path = scratch_dir(spark, "shards")
    out = sharding.shard_by_bytes(odd_docs, shards=3)
    sharding.write_shards(out, path)
    assert spark.read.parquet(path).count() == odd_docs.count()


# ------------------------------------------------------------------------ chat

def test_chat_query_equals_its_sql(spark, con):
    ok, message = oracle.compare(QUERIES["op5_chat_format"](spark, SF_SMALL), con, queries.ORACLE["op5_chat_format"])
    assert ok, message


def test_chat_round_trip_of_odd_turns(spark):
    nasty = ["</s>", "[INST]", "[/INST] x </s>[INST]user[/INST]y</s>", "\\", "\\l\\b\\a", "<", "a\\n", "", None,
             "[", "<s>", "é\U0001f600", "\\</s>", "x" * 200_000]
    rows = [(i // 4 if i < 12 else None, i if i % 5 else None, r, t, "z")
            for i, (r, t) in enumerate(zip(["user", "assistant", None, "[INST]", "a[/INST]b", "</s>", "\\b"] * 2, nasty))]
    df = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string, formatted string")
    got = {r.conv_id: r for r in chat.format_conversations(df).collect()}
    read = {r.conv_id: r for r in chat.digests(chat.format_conversations(df)).collect()}
    for c in {r[0] for r in rows}:
        turns = sorted(((t is not None, t or 0, r or "", x or "") for i, t, r, x, _ in rows if i == c))
        spoken = "".join(f"{r}\n{x}\n" for *_, r, x in turns)
        loss = "".join(x for *_, r, x in turns if r == "assistant")
        assert read[c].n_turns == len(turns)
        assert read[c].turns_sha256 == hashlib.sha256(spoken.encode()).hexdigest()
        assert (read[c].loss_chars, read[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert got[c].formatted.count("</s>") == len(turns) and got[c].formatted.count("[INST]") == len(turns)
    assert chat.format_conversations(df.where("false")).count() == 0


# --------------------------------------------------------------------- rollups

def vocabulary(path):
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_rollup_query_equals_a_recount(spark):
    coder = {n: vocabulary(p) for n, p in queries.BYTE_VOCABULARIES.items()}
    seen, want = set(), collections.defaultdict(lambda: [0, 0])
    for r in sorted(table(spark, "documents"), key=lambda r: r.doc_id):
        if r.text in seen:
            continue
        seen.add(r.text)
        n = "byte_bpe_50k" if r.lang == "en" else "byte_bpe_multi_50k"
        key = want[r.source, r.lang, n]
        key[0] += 1
        key[1] += len(coder[n].encode_ordinary(r.text or ""))
    got = {(r.source, r.lang, r.tokenizer): [r.n_docs, r.n_tokens] for r in QUERIES["op7_token_rollups"](spark, SF_SMALL).collect()}
    assert got == dict(want)


def test_rollup_counts_any_text(odd_docs):
    n, path = next(iter(queries.BYTE_VOCABULARIES.items()))
    fast, slow = rollups.PieceCounts(path, public_tokenizers.PATTERN), vocabulary(path)
    for r in odd_docs.collect() + [("", "it's  a\n\n test's   ", 0)]:
        text = r[1]
        assert fast.count(text) == len(slow.encode_ordinary(text or ""))


def test_rollup_commits_are_idempotent(spark, odd_docs, no_docs):
    counted = rollups.count_tokens(odd_docs, {"v": queries.BYTE_VOCABULARIES["byte_bpe_50k"]}, public_tokenizers.PATTERN)
    path = scratch_dir(spark, "rollup-test")
    r = rollups.Rollup(spark, path)
    read = lambda: {(x.source, x.lang): (x.n_docs, x.n_tokens) for x in r.totals().collect()}
    assert read() == {}
    assert r.commit("a", rollups.signed(counted, "v", 1)) and not r.commit("a", rollups.signed(counted, "v", 1))
    whole = read()
    assert whole[None, "en"] == (1, 0) and sum(n for n, _ in whole.values()) == odd_docs.count()
    # a commit that broke off leaves files and no mark
    rollups.signed(counted, "v", 1).groupBy("source", "lang", "tokenizer").agg(
        F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).write.parquet(f"{path}/batch-b")
    fs, mark = r._fs(f"{path}/batch-b/_SUCCESS")
    fs.delete(mark, False)
    assert read() == whole
    assert r.commit("b", rollups.signed(counted.where("source = 'a'"), "v", -1))
    assert all(s != "a" for s, _ in read())
    before = read()
    r.compact()
    assert read() == before and not r.commit("b", rollups.signed(counted, "v", 1)) and r.committed() == {"a", "b"}
    assert r.commit("c", rollups.signed(counted.where("source = 'a'"), "v", 1)) and read() == whole
    assert r.commit("d", rollups.signed(counted.where("false"), "v", 1)) and read() == whole
    with pytest.raises(ValueError):
        r.commit("../x", rollups.signed(counted, "v", 1))


# --------------------------------------------------------------------- packing

def token_ids(texts):
    t = Tokenizer.from_file(WORD_TOKENIZER)
    return {i: np.array(t.encode(x or "", add_special_tokens=False).ids + [2], "<u4") for i, x in texts}


def check_pieces(rows, ids, tokens, segments=None, loss=None):
    by = collections.defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
    assert set(by) == set(ids)
    for i, pieces in by.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids[i]) and r.length > 0
            assert r.ids_crc32 == zlib.crc32(ids[i][at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids[i])
    by = collections.defaultdict(list)
    for r in rows:
        by[r.sequence_id].append(r)
    for pieces in by.values():
        at = 0
        for k, r in enumerate(sorted(pieces, key=lambda r: r.offset)):
            assert (r.offset, r.segment) == (at, k)
            at += r.length
        assert at <= tokens and (segments is None or len(pieces) <= segments)
        assert loss is None or sum(r.loss_tokens for r in pieces) <= loss
    return by


def test_packing_query(spark):
    ids = token_ids([(r.doc_id, r.text) for r in table(spark, "documents")])
    by = check_pieces(QUERIES["op8_vector_packing"](spark, SF_SMALL).collect(), ids, 4096)
    used = [sum(r.length for r in p) for p in by.values()]
    assert sum(4096 - n for n in used if n & (n - 1)) <= 0.01 * sum(used)


def test_packing_under_three_limits(spark):
    rows = [(i, f"question {i} " * (i % 7), f"answer {i} with words " * (1 + i % 23)) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id bigint, ask string, text string").repartition(2)
    got = packing.pack(df, WORD_TOKENIZER, tokens=256, segments=5, loss_tokens=100, prompt_col="ask", with_ids=True).collect()
    ids = token_ids([(i, p + "\n" + t if p else t) for i, p, t in rows])
    check_pieces(got, ids, 256, 5, 100)
    n_prompt = {i: len(x) - 1 for i, x in token_ids([(i, p) for i, p, _ in rows]).items()}
    for r in got:
        assert r.ids == ids[r.doc_id][r.start:r.start + r.length].tolist()
        assert r.loss_tokens == max(0, r.start + r.length - max(r.start, n_prompt[r.doc_id]))


def test_packing_odd_rows(spark, odd_docs, no_docs):
    texts = {(r.doc_id, r.text) for r in odd_docs.collect()}
    once = odd_docs.dropDuplicates(["doc_id", "text"])
    check_pieces(packing.pack(once, WORD_TOKENIZER).collect(), token_ids(texts), 4096)
    assert packing.pack(odd_docs, WORD_TOKENIZER).where("doc_id = 8 AND start = 0").count() == 2
    assert packing.pack(no_docs, WORD_TOKENIZER).count() == 0


# ------------------------------------------------------------- decontamination

def test_decontamination_query(spark):
    items = {r.item_id: r.text.split() for r in table(spark, "benchmark")}
    docs = {r.doc_id: (r.text or "").split() for r in table(spark, "documents")}
    planted = {(d, i) for d, w in docs.items() for i, x in items.items()
               if any(w[k:k + len(x)] == x for k in range(len(w) - len(x) + 1))}
    got = {(r.doc_id, r.item_id) for r in QUERIES["op9_template_decontamination"](spark, SF_SMALL).collect()}
    assert planted and got == planted


ITEM = "Yesterday a farmer named Tom sold 12 sheep to Anna for 300 dollars and then Tom walked 5 miles back to the old farm with Anna"


def judge(text, items=((1, ITEM),), **more):
    return decontaminate.Index(list(items), more.get("window", 8), 4).matches(text, 0.5)


def test_decontamination_of_changed_questions():
    other = ITEM.replace("Tom", "Karl").replace("Anna", "Mia").replace("12", "47").replace("300", "91.5").replace(
        "miles", "kilometers").replace("5 k", "8 k")
    assert judge(ITEM)[0][3:5] == (9, 0)
    found = judge("We know this. " + other + " and more words follow here")
    assert [f[0] for f in found] == [1] and found[0][4] == 6
    # one name that stands for two, or two for one: not the same question
    assert not judge(other.replace("then Karl", "then Otto"))
    assert not judge(other.replace("Mia", "Karl"))
    assert not judge("A farmer sold sheep and walked home with somebody over the hill in the rain")


def test_decontamination_when_values_change_their_number_of_words():
    plain = [f"word{i}" for i in range(30)]
    item = [*plain[:10], "Tom", *plain[11:20], "Anna", *plain[21:]]
    for a, b in (("Mary Ann", "Karl Gustav"), ("Otto", "Mia Marie")):
        doc = [*plain[:10], a, *plain[11:20], b, *plain[21:]]
        assert judge("so it goes: " + " ".join(doc), [(1, " ".join(item))])[0][2] == 1
    item = " ".join([*plain[:6], "20", *plain[6:12], "5 km", *plain[12:18]])
    for a, b in (("twenty five", "7km"), ("thirty-five", "eleven hundred miles"), ("1,000", "9-mile")):
        assert judge(item.replace("20", a).replace("5 km", b), [(1, item)])[0][2] == 1
    # a word put in or left out moves the shift; parts far from each other do not count together
    item = " ".join(plain)
    assert judge(" ".join([*plain[:10], "really", *plain[10:19], *plain[20:]]), [(1, item)])[0][2] == 29 / 30
    assert not judge(" ".join([*plain[:9], *["x"] * 99, *plain[20:29]]), [(1, item)])


def test_decontamination_of_sentence_initial_names():
    item = "Mary gave 2 of her red apples away. Mary lost 1 of them on the way to school. Mary has how many left now?"
    assert judge("Hi. " + item.replace("Mary", "John").replace("2", "5"), [(1, item)])[0][2] == 1


@pytest.mark.parametrize("item", ["What is the capital of France?", "Who wrote War and Peace?", "2 + 2 =",
                                  "Compute 12 * 14 + 3", "A train leaves at 9 from Rome.",
                                  "Question\nWhat is the capital of France"])
def test_decontamination_of_verbatim_short_items(item):
    for before in ("1) ", "- ", "Quiz\n", "they asked ", "", "Well. "):
        assert [f[:3:2] for f in judge(f"{before}{item}\nand more text", [(1, item)])] == [(1, 1.0)], before
    assert judge("here " + item[0].lower() + item[1:], [(1, item)])


def test_decontamination_of_weak_items_takes_all_their_words():
    assert not judge("Compute 12 * 15 + 3", [(1, "Compute 12 * 14 + 3")])
    assert not judge("then compute 12 * 14", [(1, "Compute 12 * 14 + 3")])
    numbers = " ".join(map(str, range(100, 130)))
    assert judge("x " + numbers, [(1, numbers)])[0][2] == 1
    assert not judge(" ".join(numbers.split()[:29]), [(1, numbers)])
    # fewer words than ``least``: a line of its own
    assert judge("so:\nParis.\nyes", [(1, "Paris")]) and not judge("we saw Paris then", [(1, "Paris")])
    # a weak window of an item counts beside its template windows
    item = "count with me 1 2 3 4 5 6 7 8 9 10 11 12 and then stop for a rest at home"
    assert judge(item, [(1, item)])[0][2] == 1


@pytest.mark.parametrize("a,b,changed", [
    ("1 hour and then 3 hours", "2 hours and then 4 hours", 2), ("3 apples and then 5 pears", "4 apples and then 4 pears", 2),
    ("2 cats and then 2 dogs", "3 cats and then 5 dogs", 2), ("2 cats and then 7 dogs", "2 cats and then 2 dogs", 1),
    ("20 feet and then 1,000 grams", "twenty foot and then one thousand g", 0)])
def test_decontamination_where_numbers_coincide_or_part(a, b, changed):
    item = "in the story that we read they have {} in the garden behind the old house"
    found = judge(item.format(b), [(1, item.format(a))])
    assert found[0][2] == 1 and found[0][4] == changed


def test_decontamination_values():
    assert decontaminate._quantity("two hundred thirty-five 1,000 5km 3-hour $7.50".split()) == [
        235, 1000, 5, "km", 3, "hour", 7.5]


GARDEN = ("In the school garden {0} planted 12 rows of carrots along the fence while {1} watered 30 rows of beans "
          "behind the shed before the bell rang")


@pytest.mark.parametrize("one,two", [("O'Brien", "McDonald"), ("Anne-Marie", "DeShawn"), ("MARY", "TOM"), ("J.", "K."),
                                     ("李明", "王芳"), ("Karl", "Otto"), ("Mr. Smith", "Dr. O\u2019Neill-Jones")])
def test_decontamination_of_name_shapes(one, two):
    index = decontaminate.Index([(5, GARDEN.format("Mary", "Tom"))], 8, 4)
    assert [m[0] for m in index.matches("Once more. " + GARDEN.format(one, two) + ". The end.", 0.5)] == [5]
    plain = GARDEN.format(one, two).replace("garden", "kitchen").replace("rows", "pots").replace("fence", "wall").replace("bell", "phone")
    assert index.matches(plain, 0.5) == []


def test_decontamination_of_dozens_and_halves():
    index = decontaminate.Index([(5, GARDEN.format("Mary", "Tom"))], 8, 4)
    text = GARDEN.format("Karl", "Otto").replace("12", "a dozen").replace("30", "two dozen")
    assert [m[0] for m in index.matches(text, 0.5)] == [5]
    assert decontaminate._quantity("a dozen".split()) == [12.0] and decontaminate._quantity("two dozen".split()) == [24.0]
    assert decontaminate._quantity(["half"]) == [0.5]


def test_decontamination_of_short_items_with_other_values():
    index = decontaminate.Index([(7, "Compute 12 times 30"), (8, "What is 5?")], 8, 4)
    assert [m[0] for m in index.matches("First. Compute 15 times 20. Then rest.", 0.5)] == [7]
    assert [m[0] for m in index.matches("Notes\nCompute 7 times 8\nmore", 0.5)] == [7]
    assert index.matches("They compute 15 times 20 a day.", 0.5) == []
    assert index.matches("Compute 15 plus 20", 0.5) == []


def test_decontamination_finds_reparameterised_items():
    """500 items with every name and number changed are found among other text, and no other item is."""
    import random
    r = random.Random(5)
    vocabulary = ["".join(r.choice("bcdfglmnprst") + r.choice("aeiou") for _ in range(r.randint(2, 4))) for _ in range(900)]
    names = [w.capitalize() for w in vocabulary[:60]]
    plain = [w for w in vocabulary[60:] if w.capitalize() not in names]

    def fill(shape, who, values):
        return " ".join(who[int(x[1:])] if x[0] == "@" else values[int(x[1:])] if x[0] == "#" else x for x in shape)
    shapes = []
    for _ in range(500):
        shape = [r.choice(plain) for _ in range(r.randint(18, 40))]
        for mark, at in zip(("@0", "#0", "@1", "#1", "@0"), sorted(r.sample(range(2, len(shape)), 5))):
            shape[at] = mark
        shapes.append(shape)
    draw = lambda: (r.sample(names, 2), [str(v) for v in r.sample(range(2, 9999), 2)])
    index = decontaminate.Index([(i, fill(s, *draw())) for i, s in enumerate(shapes)], 8, 4)
    found = 0
    for i, s in enumerate(shapes):
        noise = " ".join(r.choice(plain) for _ in range(30))
        got = index.matches(f"{noise}. {fill(s, *draw())}. {noise}", 0.5)
        assert {m[0] for m in got} <= {i}
        found += len(got)
    assert found >= 0.9 * len(shapes)


def test_decontamination_odd_rows(spark, odd_docs, no_docs):
    bench = spark.createDataFrame(
        [(1, "the cat sat on the mat and looked at the moon", "x"), (2, None, "x"), (3, "", "x"), (4, "12 13 14", "x"),
         (None, "w1x1 w2x2 w3x3 w4x4 w5x5 w6x6 w7x7 w8x8 w9x9 w10x10", "x"), (5, "the cat sat on", "x")],
        "item_id bigint, text string, doc_id string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(odd_docs, bench).collect()}
    assert got == {(d, i) for d in (1, 8, None) for i in (1, 5)} | {(6, None), (7, None)}
    kept = decontaminate.clean(odd_docs, bench)
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 4, 5, 9, 10, 11]
    assert decontaminate.contaminated(no_docs, bench).count() == 0
    assert decontaminate.contaminated(odd_docs, bench.where("false")).count() == 0
    assert decontaminate.clean(odd_docs, bench.where("false")).count() == odd_docs.count()


def test_decontamination_in_blocks(spark, odd_docs, monkeypatch):
    bench = spark.createDataFrame([(i, "the cat sat on the mat and looked at the moon") for i in range(5)],
                                  "item_id bigint, text string")
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 100)
    assert len(list(decontaminate.blocks(bench, 8, 4))) == 5
    got = decontaminate.contaminated(odd_docs, bench).groupBy("doc_id").count().collect()
    assert {(r.doc_id, r["count"]) for r in got} == {(1, 5), (8, 10), (None, 5)}


# -------------------------------------------------------------------- pipeline

def test_pipeline_stage_by_stage(spark):
    from test_dedup import brute_minhash, brute_substring
    docs = common.read(spark, SF_SMALL, "documents")
    columns = docs.columns
    steps = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = common.stage(stage(spark, docs, SF_SMALL), f"test-{name}")
        steps[name] = (before, docs)
        if name != "packing":
            assert docs.columns == columns
    texts = lambda df: {r.doc_id: r.text for r in df.collect()}
    a, b = map(texts, steps["language_id"])
    assert b == {i: t for i, t in a.items() if t and any(map(str.isalpha, t))}
    a, b = map(texts, steps["near_dedup"])
    assert b == {i: a[i] for i, (_, c) in brute_minhash(list(a.items()), 5).items() if c == i}
    a, b = map(texts, steps["substring_dedup"])
    cut = brute_substring(list(a.items()))
    assert set(b) == {i for i, (n, gone, _) in cut.items() if n > gone}
    assert all(hashlib.sha256(" ".join(t.split()).encode()).hexdigest() == cut[i][2] for i, t in b.items())
    assert all(r.n_chars == len(r.text) for r in steps["substring_dedup"][1].collect())
    a, b = map(texts, steps["decontamination"])
    items = [r.text.split() for r in table(spark, "benchmark")]
    holds = lambda w: any(w[k:k + len(x)] == x for x in items for k in range(len(w) - len(x) + 1))
    assert b == {i: t for i, t in a.items() if not holds(t.split())}
    check_pieces(steps["packing"][1].collect(), token_ids(list(b.items())), 4096)


def test_pipeline_run_and_registration(spark):
    import __spark_entry__ as entry
    assert entry.queries()["pipeline"] is corpus_pipeline.run
    assert corpus_pipeline.run(spark, SF_SMALL).columns[:2] == ["doc_id", "start"]
    names = [f"op{n}_" for n in range(1, 11)]
    assert all(sum(q.startswith(n) for q in entry.queries()) == 1 for n in names)


def test_pipeline_on_odd_rows(spark, odd_docs):
    kind = common.read(spark, SF_SMALL, "documents")
    docs = odd_docs.select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))
    for name, stage in corpus_pipeline.STAGES:
        if name != "packing":
            docs = common.stage(stage(spark, docs, SF_SMALL), f"odd-{name}")
            assert docs.columns == kind.columns
            empty = stage(spark, docs.where("false"), SF_SMALL)
            assert empty.columns == kind.columns and empty.count() == 0
    assert sorted((r.doc_id or 0) for r in docs.collect()) == [0, 1, 6, 9, 11]
