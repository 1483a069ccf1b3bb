"""Ring shards, token spans and the prefix trie beside the plain way."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from lakestrata.llm import prefix_trie, ring_shards, token_spans

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


# ------------------------------------------------------------------ ring


def plain_ring(counts, owners, room):
    """Row by row: the shard of each (arc, rank), rounds of one point each."""
    free, found = list(room), {}
    asking = [(arc, rank, arc) for arc in range(len(counts)) for rank in range(counts[arc])]
    while asking:
        later = []
        for arc, rank, at in asking:
            if free[owners[at]]:
                free[owners[at]] -= 1
                found[arc, rank] = owners[at]
            else:
                later.append((arc, rank, at))
        asking = []
        for arc, rank, at in later:
            while not free[owners[at]]:
                at = (at + 1) % len(owners)
            asking.append((arc, rank, at))
    return found


@pytest.mark.parametrize("slack", [0.0, 0.3])
def test_spill_equals_row_by_row(slack):
    rng = np.random.default_rng(1)
    for _ in range(30):
        _, owners = ring_shards.Ring(5, 4).arcs()
        counts = rng.integers(0, 9, len(owners)) * (rng.random(len(owners)) < 0.7)
        counts[rng.integers(len(owners))] += 40  # one hot arc
        room = ring_shards.capacities(int(counts.sum()), 5, slack)
        found = {}
        slots = defaultdict(list)
        for arc, first, upto, shard, slot, _ in ring_shards.spill(counts, owners, room):
            for k in range(first, upto):
                assert (arc, k) not in found
                found[arc, k] = shard
                slots[shard].append(slot + k - first)
        assert found == plain_ring(counts.tolist(), owners.tolist(), room.tolist())
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_no_room_is_an_error():
    with pytest.raises(ValueError):
        ring_shards.spill(np.array([3]), np.array([0]), np.array([2]))


def check_shards(rows, shards):
    sizes = Counter(r["shard"] for r in rows)
    counts = [sizes[s] for s in range(shards)]
    assert max(counts) - min(counts) <= 1
    for shard in range(shards):
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(sizes[shard]))


def test_shards_of_odd_rows(make_docs, odd_rows):
    rows = ring_shards.shard_documents(make_docs(odd_rows), shards=4).collect()
    check_shards(rows, 4)
    expected = Counter(
        (doc_id, len((text or "").encode()) + 16, zlib.crc32((text or "").encode()))
        for doc_id, text, _, _ in odd_rows
    )
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == expected
    assert {(r["law"], r["grown_shard"]) for r in rows} == {("rows", None)}


def test_shards_of_few_and_of_no_rows(make_docs):
    check_shards(ring_shards.shard_documents(make_docs([(1, "a", "en", "s")]), 40).collect(), 40)
    assert ring_shards.shard_documents(make_docs([]), 40).collect() == []


def test_one_id_with_a_third_of_the_rows_is_spread(spark):
    docs = spark.range(900).selectExpr("IF(id % 3 = 0, -1, id) AS doc_id", "'t' AS text")
    rows = ring_shards.shard_documents(docs, shards=7).collect()
    check_shards(rows, 7)
    assert len({r["shard"] for r in rows if r["doc_id"] == -1}) > 1


def test_clashing_columns_and_order_of_rows(spark):
    """Other columns pass through, those of the result win; partitions do not matter
    to which arc's rows go where, only to which of an arc's rows."""
    docs = spark.range(500).selectExpr(
        "id AS doc_id", "'x' AS shard", "7 AS slot", "id AS extra", "id AS part"
    )
    ring = ring_shards.Ring(6, 32)
    rows = ring_shards.assign(docs, ring).collect()
    check_shards(rows, 6)
    assert all(r["extra"] == r["doc_id"] == r["part"] for r in rows)
    again = ring_shards.assign(docs.repartition(3), ring).collect()
    assert Counter(r["shard"] for r in rows) == Counter(r["shard"] for r in again)


@pytest.mark.parametrize("slack, most", [(0.0, 0.55), (0.25, 0.25)])
def test_few_rows_move_when_a_shard_is_added(spark, slack, most):
    docs = spark.range(8000).withColumnRenamed("id", "doc_id")
    before, after = (
        {r["doc_id"]: r["shard"] for r in ring_shards.assign(docs, ring_shards.Ring(n), slack=slack).collect()}
        for n in (20, 21)
    )
    moved = sum(before[d] != after[d] for d in before) / len(before)
    assert 1 / 21 * 0.5 < moved < most  # modulo the number of shards moves 0.95


# ----------------------------------------------------------- token spans


@pytest.fixture(scope="module")
def tokenizers():
    first = Tokenizer.from_file(TOKENIZER)
    first.encode_special_tokens = True
    return first, SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def sides():
    return token_spans.FirstTokenizer(TOKENIZER), token_spans.SecondTokenizer(PIECES)


def plain_groups(text, tokenizers, sides):
    """Groups of a whole text by the bytes of its tokens, [] where bytes differ."""
    if not text:
        return []
    raw = (" " + text).encode()
    ids = (
        tokenizers[0].encode(" " + text, add_special_tokens=False).ids,
        tokenizers[1].encode(text),
    )
    ends = []
    for side, found in zip(sides, ids):
        if b"".join(side.bytes[i] for i in found) != raw:
            return []
        upto = np.cumsum([len(side.bytes[i]) for i in found]).tolist()
        ends.append({end: k + 1 for k, end in enumerate(upto)})
    cuts = sorted(set(ends[0]) & set(ends[1]))
    groups, at = [], [0, 0]
    for cut in cuts:
        group = []
        for k in (0, 1):
            upto = ends[k][cut]
            group.append(ids[k][at[k] : upto])
            at[k] = upto
        groups.append(tuple(group))
    return groups


def as_text(groups):
    return ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)


def plain_counts(rows, tokenizers, sides):
    """The result of ``alignment_counts`` row by row."""
    found = [(doc_id, plain_groups(text, tokenizers, sides)) for doc_id, text, *_ in rows]
    links = [Counter((a, b) for g in groups for a in g[0] for b in g[1]) for _, groups in found]
    count = Counter(pair for of_doc in links for pair in of_doc)
    highest = defaultdict(int)
    for (a, _), n in count.items():
        highest[a] = max(highest[a], n)
    return Counter(
        (
            doc_id,
            sum(len(g[0]) for g in groups),
            sum(len(g[1]) for g in groups),
            len(groups),
            sum(of_doc.values()),
            sum(n for pair, n in of_doc.items() if count[pair] == highest[pair[0]]),
            sum(n * count[pair] for pair, n in of_doc.items()),
            hashlib.sha256(as_text(groups).encode()).hexdigest() if groups else "",
        )
        for (doc_id, groups), of_doc in zip(found, links)
    )


ALPHABET = ["a", "b", " ", "  ", "\n", "'s", "é", "ß", "1", "²", "$", "\t", "the", "aaaa", "_",
            "\x1c", "日本", "ा", "😀", "Ⅷ", "\x00", "<|endoftext|>", "<s>", "<0x41>", "▁", " the",
            " größe", "　", "\xa0", "ﬁ", "é", ".", "\r\n"]


def odd_texts(count, seed=4):
    rng = random.Random(seed)
    texts = ["".join(rng.choices(ALPHABET, k=rng.randint(0, 25))) for _ in range(count)]
    return [*texts, "", " ", "  a", "a  ", " a b", "x" * 3000, " " * 500, "\n " * 200, "▁", "a ▁b c"]


def test_groups_equal_those_of_whole_texts(tokenizers, sides):
    aligner = token_spans.Aligner(*sides)
    texts = odd_texts(3000)
    for text, row in zip(texts, aligner.rows(texts)):
        expected = plain_groups(text, tokenizers, sides)
        assert aligner.sound(row) == bool(expected), text
        if expected:
            assert aligner.text_of_groups(row) == as_text(expected), text


def test_spans_are_refined_to_bytes(tokenizers, sides):
    """Coarse spans do not tell the tokens of one character apart; refined ends do."""
    text = " größe 日本 Ⅷ 😀x \x01é"
    for side in sides:
        ((ids, starts, ends),) = side.spans([text])
        widths = side.widths[ids]
        assert (ends - starts != widths).any()
        assert token_spans.refined_ends(starts, ends, widths).tolist() == np.cumsum(widths).tolist()


def test_wide_groups_count_repeated_ids(monkeypatch, tokenizers, sides):
    texts = odd_texts(300, seed=9)
    usual = token_spans.Aligner(*sides)
    expected = [usual.linked(r) for r in usual.rows(texts)]
    monkeypatch.setattr(token_spans, "_WIDE", 0)
    wide = token_spans.Aligner(*sides)
    for (pairs, links), row in zip(expected, wide.rows(texts)):
        found = wide.linked(row)
        assert found[0].tolist() == pairs.tolist() and found[1].tolist() == links.tolist()


def test_memory_of_pieces_is_bounded(sides):
    aligner = token_spans.Aligner(*sides, limit=500, room=20_000)
    for batch in range(20):
        texts = [f"word{batch}x{k}  and   {'y' * k} {k}" for k in range(100)]
        aligner.rows(texts)
        assert len(aligner.groups) <= 500 + 500 and aligner.held <= 20_000 + 20_000


def test_counts_of_odd_rows(make_docs, odd_rows, tokenizers, sides):
    rows = odd_rows + [(100 + k, text, "en", "a") for k, text in enumerate(odd_texts(150, 6))]
    found = token_spans.alignment_counts(make_docs(rows), TOKENIZER, PIECES)
    assert found.columns == [c.split()[0] for c in token_spans._RESULT.split(", ")]
    assert Counter(map(tuple, found.collect())) == plain_counts(rows, tokenizers, sides)


def test_counts_over_many_blocks(make_docs, random_docs, tokenizers, sides):
    docs = make_docs(random_docs)
    small = token_spans.blocks(docs, TOKENIZER, PIECES, chars=2_000)
    assert small.where("is_block").count() >= 20
    found = token_spans.alignment_counts(docs, TOKENIZER, PIECES, chars=2_000)
    assert Counter(map(tuple, found.collect())) == plain_counts(random_docs, tokenizers, sides)


def test_no_documents_have_no_counts(make_docs):
    assert token_spans.alignment_counts(make_docs([]), TOKENIZER, PIECES).collect() == []
    nothing = token_spans.alignment_counts(make_docs([(1, None, None, None)]), TOKENIZER, PIECES)
    assert [tuple(r) for r in nothing.collect()] == [(1, 0, 0, 0, 0, 0, 0, "")]


def test_align_gives_spans(make_docs, tokenizers, sides):
    text = "Die größe 日本 Ⅷ end"
    (row,) = token_spans.align(make_docs([(1, text, "de", "a")]), TOKENIZER, PIECES).collect()
    assert [(g["a"], g["b"]) for g in row["groups"]] == plain_groups(text, tokenizers, sides)
    raw = (" " + text).encode()
    assert b"".join(raw[g["start"] : g["end"]] for g in row["groups"]) == raw
    for group in row["groups"]:
        part = b"".join(sides[0].bytes[i] for i in group["a"])
        assert part == raw[group["start"] : group["end"]]


# ------------------------------------------------------------------ trie


def plain_trie(rows):
    """All nodes, every prefix of every rebuilt conversation held in memory."""
    own = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            turn_key = (turn is not None, turn or 0)
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role)} {role}{text}".encode()).hexdigest()
            own[conv_id].append((turn_key, tie, role, text))
    turns = {c: [(r, t) for *_, r, t in sorted(cells)] for c, cells in own.items()}
    members = defaultdict(list)
    for c, mine in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        path = turns.get(base, [])[:h] + mine[h:]
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append((c, d == len(path)))
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    found = {}
    for node in sorted(members, key=len, reverse=True):
        ids = [c for c, _ in members[node]]
        below = [found[child] for child in children[node]]
        words = len([w for w in node[-1][1].replace("\x0b", " ").split() if w]) if node else 0
        ends = ",".join(map(str, sorted(c for c, end in members[node] if end)))
        found[node] = (
            min(ids),
            len(node),
            min(c for c, _ in members[node[:-1]]) if node else None,
            len(ids),
            len(below),
            sum(b[5] for b in below) or 1,
            (len(ids) - 1) * words + sum(b[6] for b in below),
            hashlib.sha256(ends.encode()).hexdigest(),
        )
    return Counter(found.values())


SCHEMA = (
    "conv_id long, turn long, role string, text string, "
    "base long, node string, path string, words long, kind string"  # names used inside
)


def trie_rows(df, shards):
    found = prefix_trie.conversation_trie(df, shards)
    names = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256"
    return Counter(map(tuple, found.select(*names.split()).collect()))


@pytest.fixture(scope="module")
def make_talks(spark):
    def make(rows):
        return spark.createDataFrame([(*r, *[None] * 5) for r in rows], SCHEMA)

    return make


def talks(count, seed, hot=0):
    """Conversations over few turns, so that prefixes are shared; some ids are absent."""
    rng = random.Random(seed)
    rows = []
    for c in range(-25, count):
        if rng.random() < 0.1:
            continue
        if hot and rng.random() < hot:
            path = [("user", "hot one"), ("assistant", "hot two three"), ("user", "end")]
        else:
            path = [
                (rng.choice(["user", "assistant", None]), rng.choice(["a", "b c", "", None, "d  e\tf"]))
                for _ in range(rng.choice([1, 1, 2, 3, 4, 6]))
            ]
        rows += [(c, k, role, text) for k, (role, text) in enumerate(path)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("shards, hot", [(1, 0.4), (7, 0), (40, 0.4)])
def test_trie_equals_all_prefixes(make_talks, shards, hot):
    rows = talks(300, shards, hot)
    assert trie_rows(make_talks(rows), shards) == plain_trie(rows)


def test_trie_of_odd_rows(make_talks):
    rows = [
        (1, 0, "user", "a b"), (1, 0, "user", "a b"), (1, 0, "user", "c"),  # ties and copies
        (2, None, "user", "first"), (2, -3, None, None), (2, 5, "user", "x" * 200_000),
        (None, 0, "user", "of no conversation"),
        (3, 0, None, None), (40, 0, "user", "long " * 50_000), (41, None, None, None),
        (-3, 0, "user", "a b"), (-23, 0, "user", "a b"), (2**62, 0, "user", "a b"),
    ]
    rows += [(60, k, "user", f"turn {k % 7}") for k in range(400)]
    rows += [(61 + c, k, "user", f"turn {k % 7}") for c in range(3) for k in range(400)]
    assert trie_rows(make_talks(rows), 5) == plain_trie(rows)


def test_trie_of_nothing(make_talks):
    assert not trie_rows(make_talks([]), 4)
    assert not trie_rows(make_talks([(None, 1, "user", "a")]), 4)


def test_copies_of_one_path_are_cut(make_talks):
    """A conversation that all hold lies in several shards, and its ends meet in order."""
    rows = [(c, 0, "user", "same") for c in range(0, 4000, 20)]
    paths = prefix_trie.rebuilt_paths(make_talks(rows))
    cuts = prefix_trie.splitters(paths, 6)
    assert len({path for path, _ in cuts}) < len(cuts)
    assert trie_rows(make_talks(rows), 6) == plain_trie(rows)
