import base64
import random

import pytest
import public_tokenizers as P
from hypothesis import given, settings, strategies as st

from tidemark.llm import token_file
from tidemark.llm.bpe import Merger, RankQueue, _coder, bpe_decode, bpe_encode, encode_text, load_ranks
from tidemark.llm.token_file import _library_encoder

PATH, PATTERN = P.path("byte_bpe_50k.tiktoken"), P.PATTERN
ALPHABET = "ab é'strem19\n\n\t\r  .,!<|endoftext|>\x1c\x85\xa0 ​中文🙂"


@pytest.fixture(scope="module")
def reference():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    return tokenizer


def random_texts(n, seed=7):
    pick = random.Random(seed)
    words = ["the", "word", "isn't", "x" * 70, "naïve", "word,", "(word)", "12ab", "\n", "\n\n", " ", "", "  ", "\t", "\r\n", " \n", "\n ", "a\nb", "<|endoftext|>"]
    for _ in range(n):
        yield " ".join(pick.choice(words) for _ in range(pick.randrange(0, 30)))
        yield "".join(pick.choice(ALPHABET) for _ in range(pick.randrange(0, 40)))


def test_same_ids_as_both_libraries(reference, library):
    own, other = _coder(PATH, PATTERN)[0], _library_encoder(P.path("byte_bpe_50k.json"), PATTERN)
    texts = [*random_texts(1500), "", " ", "\n", " \n", "\n ", "a\n", "a \n b", "a\t\n", "a\t\nb", "\n\n\nx"]
    for text, ours, theirs in zip(texts, own.encode(texts), other.encode(texts)):
        wanted = reference.encode_ordinary(text)
        assert [int.from_bytes(ours[i : i + 4], "little") for i in range(0, len(ours), 4)] == wanted, repr(text)
        wanted = library.encode(text, add_special_tokens=False).ids
        assert [int.from_bytes(theirs[i : i + 4], "little") for i in range(0, len(theirs), 4)] == wanted, repr(text)


def test_very_long_piece(reference):
    text = "abcabd" * 20_000
    assert encode_text(text, PATH, PATTERN) == reference.encode_ordinary(text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 9000), st.integers(0, 50)), max_size=60))
def test_rank_queue_gives_lowest_rank_and_leftmost_first(entries):
    queue, got = RankQueue(9001), []
    for rank, place in entries:
        queue.push(rank, place)
    while True:
        rank, places = queue.pop()
        if rank < 0:
            break
        got += [(rank, p) for p in places]
    assert got == sorted(entries)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text("abc", min_size=1, max_size=12), max_size=8), st.randoms(use_true_random=False))
def test_merger_against_plain_merging(pieces, pick):
    tokens = {bytes([b]) for b in b"abc"} | {"".join(pick.choice("abc") for _ in range(pick.randrange(2, 5))).encode() for _ in range(12)}
    ordered = sorted(tokens, key=lambda t: (len(t) > 1, pick.random()))
    ranks = {t: i for i, t in enumerate(ordered)}

    def plain(piece):
        if piece in ranks:
            return [ranks[piece]]
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while True:
            pairs = [(ranks[parts[i] + parts[i + 1]], i) for i in range(len(parts) - 1) if parts[i] + parts[i + 1] in ranks]
            if not pairs:
                return [ranks[p] for p in parts]
            _, i = min(pairs)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    data = [p.encode() for p in pieces]
    assert Merger(ranks).ids(data) == [plain(p) for p in data]


def test_round_trip_on_a_table(spark):
    rows = [(1, "a word, naïve"), (2, None), (3, ""), (4, "x" * 5000), (4, "x" * 5000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'clash' as ids", "'clash' as decoded")
    out = bpe_decode(bpe_encode(docs, PATH, PATTERN), PATH, PATTERN).collect()
    assert sorted((r.doc_id, bytes(r.decoded).decode()) for r in out) == sorted((i, t or "") for i, t in rows)
    assert bpe_encode(docs.limit(0), PATH, PATTERN).count() == 0
    assert len(load_ranks(PATH)) == 50256


@pytest.mark.parametrize("n", [0, 1, 2, 5, 47, 400])
def test_index_tries_many_displacements_at_a_time(monkeypatch, n):
    pick = random.Random(n)
    keys = list({pick.randrange(-(2**63), 2**63) for _ in range(n // 2)} | set(range(n - n // 2)))
    at, lengths, place = [pick.randrange(2**31) for _ in keys], [pick.randrange(2**16) for _ in keys], token_file._place
    # the first displacement that fits, one after the other
    hashed, free, found = [token_file._mix(k % 2**64) for k in keys], [True] * n, {}
    buckets = [[h for h in hashed if (h >> 32) % max(1, -(-n // token_file.BUCKET_KEYS)) == b] for b in range(max(1, -(-n // token_file.BUCKET_KEYS)))]
    for b in sorted(range(len(buckets)), key=lambda b: -len(buckets[b])):
        d = 0
        while len({p for h in buckets[b] if free[p := place(h, d, n)]}) < len(buckets[b]):
            d += 1
        found[b] = d
        for h in buckets[b]:
            free[place(h, d, n)] = False
    with monkeypatch.context() as held:
        held.setattr(token_file, "_place", None)  # a call for each key and displacement took a fifth of op4's time
        segment = token_file.Segment(token_file.build_index(keys, at, lengths), b"")
    assert segment.displacements == [found[b] for b in range(len(buckets))]
    assert [segment.find(k) for k in keys] == list(zip(at, lengths))


def test_model_encodes_joined_pieces_as_each_alone():
    from tokenizers import Tokenizer

    class Counted:
        def __init__(self, model):
            self.model, self.calls = model, 0

        def tokenize(self, text):
            self.calls += 1
            return self.model.tokenize(text)

        def __getattr__(self, name):
            return getattr(self.model, name)

    tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    pick, model, vocabulary = random.Random(8), tokenizer.model, tokenizer.get_vocab(with_added_tokens=False)
    pieces = [" " + "".join(pick.choices("etaoinsh\u00ff\u0120\u00df\U0001f600,.7 \n\x00", k=pick.randrange(1, 30))) for _ in range(2000)] + ["\u00ff", " ", "a" * 40000, "\n"]
    counted = Counted(model)
    ids, counts = token_file._model_encoder(counted, vocabulary)(pieces)
    spelled = ["".join(token_file._spelling(b) for b in p.encode()) for p in pieces]
    alone = [[t.id for t in model.tokenize(p)] for p in spelled]
    assert list(counts) == [len(x) for x in alone] and ids.tolist() == [i for x in alone for i in x]
    assert counted.calls <= -(-len(pieces) // token_file.JOINED_PIECES)
    assert [len(x) for x in token_file._model_encoder(model, vocabulary)([])] == [0, 0]
    # a token that has the parting byte beside others: each piece by itself
    counted.calls = 0
    ids, counts = token_file._model_encoder(counted, vocabulary | {token_file._spelling(255) * 2: -1})(pieces)
    assert counted.calls == len(pieces) and list(counts) == [len(x) for x in alone] and ids.tolist() == [i for x in alone for i in x]
