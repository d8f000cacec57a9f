"""Cross-tokenizer alignment, conversation repair and fingerprints against brute-force versions."""

import hashlib
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import xxhash
from tokenizers import Tokenizer

from sensorlytics.llm import conversation_repair as C
from sensorlytics.llm import fingerprints as S
from sensorlytics.llm import token_alignment as A
from sensorlytics.llm.bpe import byte_letters


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda t: tuple((x is None, x or 0) for x in t))


# ------------------------------------------------------------------ op11

ALPHABET = ["a", "b", "B", "1", ".", " ", "  ", "\n", "é", "中", "'s", "\t", "ing", "the", " ", "▁", "🙂", "\r\n", "\x1d"]


def odd_texts():
    rng = random.Random(5)
    rows = [(None, None), (1, ""), (1, " "), (2, "a  b"), (3, "x \n y\t\t z  "), (4, "▁a b"), (5, "é" * 3000 + " " + "中" * 500),
            (6, "it's <|endoftext|> <s> 12 34 x y\x85 z\x1c q"), (None, "dup dup"), (7, "   lead"), (8, "trail   "),
            (9, "a　 b"), (10, "\n"), (11, "x" * 20000), (12, "🙂 👍🏽 ﬁ ½ ok"), (12, "🙂 👍🏽 ﬁ ½ ok")]
    return rows + [(100 + i, "".join(rng.choices(ALPHABET, k=rng.randint(1, 40)))) for i in range(150)]


def plain_alignment(rows):
    """Whole texts through both libraries, counts in a dictionary."""
    a = Tokenizer.from_file(public_tokenizers.path(A.TOKENIZER_A))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(A.TOKENIZER_B))
    of_letter = {c: i for i, c in enumerate(byte_letters())}
    bytes_a = {i: bytes(of_letter[c] for c in t) if all(c in of_letter for c in t) else t.encode() for t, i in a.get_vocab().items()}
    docs, counts = [], Counter()
    for doc_id, text in rows:
        raw = (" " + (text or "")).encode()
        ids_a = a.encode(raw.decode(), add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        parts_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids_b, map(b.id_to_piece, ids_b))]
        parts_a = [bytes_a[i] for i in ids_a]
        if b"".join(parts_a) != raw or b"".join(parts_b) != raw:
            docs.append((doc_id, 0, 0, [], []))
            continue
        ends_a, ends_b = np.cumsum([len(p) for p in parts_a]).tolist(), np.cumsum([len(p) for p in parts_b]).tolist()
        groups, links, i, j = [], [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            k, m = ends_a.index(end), ends_b.index(end)
            groups.append(",".join(map(str, ids_a[i:k + 1])) + "|" + ",".join(map(str, ids_b[j:m + 1])))
            links.append((ids_a[k], ids_b[m]))
            i, j = k + 1, m + 1
        counts.update(links)
        docs.append((doc_id, len(ids_a), len(ids_b), groups, links))
    best = {}
    for (_, j), n in counts.items():
        best[j] = max(best.get(j, 0), n)
    return [(d, na, nb, len(g), len(ls), sum(counts[p] == best[p[1]] for p in ls), sum(counts[p] for p in ls),
             hashlib.sha256(";".join(g).encode()).hexdigest() if g else "") for d, na, nb, g, ls in docs], counts, best


def test_alignment_of_odd_texts(spark):
    rows = odd_texts()
    df = spark.createDataFrame([(i, t, "x", 3) for i, t in rows], "doc_id long, text string, run string, groups int").repartition(5)
    expected, counts, best = plain_alignment(rows)
    # several runs a task, several levels of merging
    assert ordered(A.link_sums(df, run_links=300, fan_in=3).collect()) == ordered(expected)
    totals = A.total_counts(A.spill_runs(df, run_links=200), fan_in=2)
    assert sorted(map(tuple, A.pair_counts(totals).collect())) == sorted((a, b, n, n == best[b]) for (a, b), n in counts.items())
    groups = {h for *_, h in expected if h}
    assert {hashlib.sha256(r.groups.encode()).hexdigest() for r in A.alignments(df).collect() if r.groups} == groups
    assert A.link_sums(df.limit(0)).count() == 0


def test_alignment_of_documents(spark, tmp_path):
    path = "/root/testdata/sf0.001"
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{path}/documents.parquet'").fetchall()
    assert ordered(A.op11_token_alignment(spark, path).collect()) == ordered(plain_alignment(rows)[0])


def test_streams_merge_and_pack():
    rng = np.random.default_rng(1)
    streams = [(np.unique(rng.integers(0, 500, 200)), None) for _ in range(7)]
    streams = [(c, rng.integers(1, 9, len(c))) for c, _ in streams]
    codes, counts = A.merge_streams(streams)
    whole = Counter()
    for c, n in streams:
        whole.update(dict(zip(c.tolist(), n.tolist())))
    assert dict(zip(codes.tolist(), counts.tolist())) == dict(whole) and (np.diff(codes) > 0).all()
    for v in (np.zeros(0, np.int64), np.array([5, -3, 2**62, 0])):
        assert A.unpacked(A.packed(v)).tolist() == v.tolist()
    b = np.arange(1 << A.B_BITS)
    assert (A.unmixed(A.mixed(b)) == b).all()


def test_a_forgetful_worker_gives_the_same(monkeypatch):
    texts = [t or "" for _, t in odd_texts()]
    paths = A._paths(None, None)
    one = A.Aligner(*paths).align(texts)
    monkeypatch.setattr(A, "MEMO", 20)
    other, parts = A.Aligner(*paths), []
    for t in texts:
        parts.append(other.align([t]))
    assert [p[1][0] for p in parts] == one[1]
    assert np.concatenate([p[2] for p in parts]).tolist() == one[2].tolist()


# ------------------------------------------------------------------ op12

def plain_repair(symbols):
    """Forward search over (cost, audit), one row after the other."""

    def inserted(best):
        best = dict(best)
        for _ in range(3):
            for state, (cost, audit) in list(best.items()):
                to = C.ADDED[state]
                best[to] = min(best.get(to, (1 << 30, "")), (cost + C.INSERT, audit + "I"))
        return best

    best = {C.START: (0, "")}
    for s in symbols:
        found = {}

        def put(state, cost, audit):
            found[state] = min(found.get(state, (1 << 30, "")), (cost, audit))

        for state, (cost, audit) in inserted(best).items():
            put(state, cost + C.DELETE, audit + "D")
            if C.SYMBOLS[s] is not None:
                initial, cut = C.SYMBOLS[s]
                more = C.TRUNCATED * cut
                put(C.ADDED[state], cost + C.NEW_ROLE + more, audit + "R")
                if (state, initial) in C.KEPT:
                    put(C.KEPT[state, initial], cost + more, audit + "K")
        best = found
    return min(v for k, v in inserted(best).items() if k in (C.START, C.AFTER_A))


@pytest.mark.parametrize("length", [1, 3, 4])
def test_block_tables_against_search(length):
    tables, rng = C.BlockTables(length), random.Random(length)
    for n in [0, 1, 2, 3, 4, 5, 8, 9, *[rng.randint(0, 14) for _ in range(150)]]:
        symbols = [rng.randrange(len(C.SYMBOLS)) for _ in range(n)]
        assert tables.repair(np.array(symbols, np.uint8)) == plain_repair(symbols), symbols


def test_repair_of_odd_conversations_against_sql(spark, tmp_path):
    rng = random.Random(3)
    rows = [(None, None, None, None), (None, 1, "user", "a."), (1, None, "user", ""), (1, None, "user", ""), (2, 5, "tool", "x"),
            (2, 5, "tool", "x"), (2, 9, "", "y!"), (2, 9, "system", "zz?"), (3, 0, "assistant", "q."), (3, 4, "Ünser", "b."),
            (-4, 2**40, "user", "long " * 50_000)]
    for conv in range(10, 300):
        for turn in range(rng.randint(1, 9)):
            rows.append((conv, rng.choice([None, turn, turn, turn + 1]), rng.choice(["user", "assistant", "system", "x", "", None]),
                         rng.choice(["a.", "b", "c!", "", " \n", None, "d?  ", "é. ", "z"])))
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df.write.parquet(str(tmp_path / "conversations.parquet"))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    expected = con.sql(C.ORACLE)
    got = C.op12_conversation_repair(spark, str(tmp_path)).select(*expected.columns)
    assert ordered(got.collect()) == ordered(expected.fetchall())


def test_one_giant_conversation_is_spread(spark, conf):
    conf("spark.sql.shuffle.partitions", 6)
    n = 3000
    rows = spark.range(n).selectExpr("7L AS conv_id", "id AS turn", "IF(id % 2 = 0, 'user', 'assistant') AS role",
                                     "concat('t', id, '.') AS text", "'clash' AS audit", "1 AS cost")
    found = C.audits(rows).collect()
    assert [(r.gaps, r.illegal, r.cost, r.audit) for r in found] == [(0, 0, 0, "K" * n)]
    repaired = C.repaired_rows(rows, C.audits(rows)).orderBy("position").collect()
    assert [r.text for r in repaired] == [f"t{i}." for i in range(n)]
    assert C.audits(rows.limit(0)).count() == 0


def test_damage_follows_the_crc(spark):
    rows = [(c, t, "system", "a. b!") for c in range(20) for t in range(20)]
    got = {(r.conv_id, r.turn): r for r in C.damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    for c, t, *_ in rows:
        how = zlib.crc32(f"{c}:{t}".encode()) % 20
        r = got[c, t]
        assert (r.copies, r.role, r.text) == ({0: 0, 3: 2}.get(how, 1), "user" if how == 4 else "system", {1: "", 2: "a b"}.get(how, "a. b!"))


# ------------------------------------------------------------------ op13

def plain_fingerprint(text):
    votes, whole = [0] * 64, 0
    for term in set(re.findall(S.TERM, text.lower())) or {""}:
        h, w = xxhash.xxh64_intdigest(term.encode(), 42), max(1, len(term))
        whole += w
        for i in range(64):
            votes[i] += w * (h >> i & 1)
    return sum(1 << i for i, v in enumerate(votes) if 2 * v > whole)


def plain_comparison(rows):
    def signed_hash(t):
        h = xxhash.xxh64_intdigest(t.encode(), 42)
        return h - (1 << 64) if h >> 63 else h

    rows = [(d, t or "") for d, t in rows]
    stands = {}
    for d, t in rows:
        if d not in stands or signed_hash(t) < signed_hash(stands[d]):
            stands[d] = t
    order = sorted((d for d in stands if d is not None), reverse=True) + [None] * (None in stands)
    after = {d: order[(i + 1) % len(order)] for i, d in enumerate(order)}
    fps = np.array([plain_fingerprint(t) for _, t in rows], np.uint64)
    out = []
    for (d, t), fp in zip(rows, fps.tolist()):
        k, following = len(t) // 3, stands[after[d]]
        edited = t[:len(t) - k] + following[:k]
        efp = plain_fingerprint(edited)
        near = int((np.bitwise_count(fps ^ np.uint64(fp)) <= S.RADIUS).sum()) - 1
        out.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), f"{fp:016x}", f"{efp:016x}", 1 - (fp ^ efp).bit_count() / 64,
                    1 - (fp ^ plain_fingerprint(following)).bit_count() / 64, near))
    return out


def test_fingerprints_of_documents(spark):
    path = "/root/testdata/sf0.001"
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{path}/documents.parquet'").fetchall()
    assert ordered(S.op13_fingerprints(spark, path).collect()) == ordered(plain_comparison(rows))


def test_fingerprints_of_odd_rows(spark, conf):
    rows = [(None, None), (None, "x y z"), (None, "x y z"), (1, ""), (1, "é" * 30), (2, "a"), (2, "a"), (2, "a"), (5, "中" * 100),
            (5, "some other words here"), (-3, "k " * 5000), (2**62, "Ω tail"), (-2**63, "least")] + [(2, f"w{i} v{i}") for i in range(40)]
    df = spark.createDataFrame([(i, t, "c", 0) for i, t in rows], "doc_id long, text string, fp string, n int").repartition(3)
    expected = ordered(plain_comparison(rows))
    assert ordered(S.compared(df).collect()) == expected
    # ids that many rows share, salted
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("sensorlytics.skew.rowsPerTask", 5)
    assert ordered(S.compared(df).collect()) == expected
    assert S.compared(df.limit(0)).count() == 0


@pytest.mark.parametrize("crowd", [10, 10_000])
def test_near_pairs_are_all_found(spark, crowd):
    rng = random.Random(2)
    base, fps = rng.getrandbits(64), set()
    while len(fps) < 500:  # a dense group: few positions differ
        x = base
        for _ in range(rng.randint(0, 5)):
            x ^= 1 << rng.randrange(24)
        fps.add(x)
    fps |= {rng.getrandbits(64) for _ in range(200)}
    signed = np.array(sorted(fps), np.uint64).view(np.int64)
    found = [tuple(r) for r in S.near_pairs(spark.createDataFrame([(int(x),) for x in signed], "fp long"), crowd=crowd).collect()]
    expected = {(min(int(a), int(b)), max(int(a), int(b))) for i, a in enumerate(signed) for b in signed[:i]
                if bin((int(a) ^ int(b)) & 0xFFFFFFFFFFFFFFFF).count("1") <= 3}
    assert len(found) == len(set(found)) and set(found) == expected


def test_fingerprints_stay_in_the_jvm(spark):
    plan = S.compared(spark.createDataFrame([(1, "a b"), (2, "c d")], "doc_id long, text string"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
