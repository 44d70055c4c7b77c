"""Methods against brute force, without Spark."""

import math
import random
from collections import Counter
from itertools import product
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from gapwatch.llm import fingerprints, langid, mixing, neardup, packing, shingles, toxicity
from gapwatch.llm.html import rendered
from gapwatch.llm.queries import tokenizer_path

LETTERS = "abcdeABC  \n\t''sStreve.!?#12ΣσςİıéÉ 　\x1c\x1f\x85日本🙂aaaannnn"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def test_automaton_agrees_with_the_library(library):
    from gapwatch.llm.automaton import WordBpe

    bpe, dice = WordBpe(tokenizer_path()), random.Random(4)
    for k in range(4000):
        text = "".join(dice.choice(LETTERS) for _ in range(dice.randrange(40)))
        if k % 40 == 0:
            text += "<|endoftext|>x<|startoftext|> <|endoftext|"
        ids = library.encode(text, add_special_tokens=False).ids
        assert bpe.encode(text).tolist() == ids
        assert bpe.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_automaton_on_an_alphabet_with_overlapping_merges():
    from gapwatch.llm.automaton import MergeAutomaton

    merges = [("a", "a"), ("aa", "a"), ("b", "aa"), ("a", "b"), ("aa", "b"), ("ab", "ab")]
    vocabulary = {t: i for i, t in enumerate(["a", "b", *dict.fromkeys(a + b for a, b in merges)])}
    with pytest.raises(ValueError):
        MergeAutomaton(vocabulary | {"aab": 99}, [*merges, ("a", "ab")])
    automaton, rank = MergeAutomaton(vocabulary, merges), {m: i for i, m in enumerate(merges)}
    for n in range(1, 9):
        for bits in range(1 << n):
            word = "".join("ab"[bits >> i & 1] for i in range(n))
            parts = list(word)
            while pairs := [(rank[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in rank]:
                _, i = min(pairs)
                parts[i: i + 2] = [parts[i] + parts[i + 1]]
            assert automaton.path(word, end="") == [vocabulary[p] for p in parts]


@pytest.mark.parametrize("cut", [True, False])
def test_packer_keeps_every_limit_and_every_token(cut):
    dice, pieces = random.Random(cut), []
    packer = packing.Packer(0, 64, 5, 40, cut)
    for doc in range(300):
        ids = np.arange(dice.randrange(1, 60), dtype="<u4")
        loss = np.array([dice.random() < 0.6 for _ in ids]) if doc % 3 else np.zeros(len(ids), bool)
        pieces.append((doc, ids, loss))
        packer.add((doc, 0, ids, len(ids), loss))
    found, sequences = {}, {}
    for (doc, start, ids, total, loss), sequence, segment, offset in packer.pack(0):
        found.setdefault(doc, []).append((start, ids, loss))
        own = sequences.setdefault(sequence, [0, 0, 0])
        assert (segment, offset) == (own[1], own[0])
        sequences[sequence] = [own[0] + len(ids), own[1] + 1, own[2] + int(loss.sum())]
    assert all(t <= 64 and s <= 5 and b <= 40 for t, s, b in sequences.values())
    for doc, ids, loss in pieces:
        parts = sorted(found[doc], key=lambda p: p[0])
        assert np.concatenate([p[1] for p in parts]).tolist() == ids.tolist()
        assert np.concatenate([p[2] for p in parts]).tolist() == loss.tolist()
        assert cut or len(parts) == 1 or loss.sum() > 40


def test_word_hashes_and_shingles():
    text = "A b\tc  D\x0be f. a B c d e f. "
    assert shingles.word_hashes(text)[:6].tolist() == shingles.word_hashes(text)[6:].tolist()
    assert len(shingles.shingle_set(shingles.word_hashes(text), 5)) == 6
    assert len(shingles.shingle_set(shingles.word_hashes("x y"), 5)) == 1
    assert not len(shingles.word_hashes(" \n ")) and not len(shingles.word_hashes(""))
    words = [f"{a}{b}{c}" for a in "abcdefghij" for b in "abcdefghij" for c in "abcdefghij"]
    assert len(set(shingles.word_hashes(" ".join(words)).tolist())) == 1000


def test_b_bit_estimate_is_near_the_similarity():
    rng = np.random.default_rng(3)
    for share in (0.2, 0.5, 0.75, 0.9, 1.0):
        errors = []
        for _ in range(30):
            pool = rng.integers(0, 1 << 63, 800, dtype=np.uint64)
            common = int(800 * share)
            rest = pool[common:]
            one = np.concatenate((pool[:common], rest[::2]))
            other = np.concatenate((pool[:common], rest[1::2]))
            true = len(np.intersect1d(one, other)) / len(np.union1d(one, other))
            a, b = (np.frombuffer(neardup.packed(neardup.minima(x)), np.uint8)[None] for x in (one, other))
            errors.append(neardup.estimated(a, b)[0] - true)
        assert abs(np.mean(errors)) < 0.03 and np.abs(errors).max() < 0.25


def test_window_entropies_and_digests():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 110, 400).astype(np.uint8)
    for at, h in enumerate(fingerprints.entropies(data)):
        c = np.array(list(Counter(data[at: at + 64].tolist()).values()))
        assert abs(-(c / 64 * np.log2(c / 64)).sum() * 1000 - h) < 2
    words = [f"w{rng.integers(10**6)}" for _ in range(600)]
    text, half = " ".join(words), " ".join(words[:400] + [f"v{rng.integers(10**6)}" for _ in range(200)])
    texts = ["", "short", text, half, text[::-1], "x" * 500]
    single = [fingerprints.fingerprint(t).tobytes() for t in texts]
    assert [d.tobytes() for d in fingerprints.digests(texts)] == single
    a, b, c = (fingerprints.fingerprint(t) for t in (text, half, text[::-1]))
    assert fingerprints.likeness(a, a) == 1 and fingerprints.likeness(a, b) > 0.5 > 0.3 > fingerprints.likeness(a, c)
    empty = fingerprints.fingerprint("")
    assert fingerprints.likeness(empty, empty) == 1 and fingerprints.likeness(empty, a) == 0


def test_a_words_probabilities_sum_to_at_most_one():
    words = np.frombuffer(b"thethesethatabc", np.uint8)
    lengths = np.array([3, 5, 4, 3])
    counts = mixing.Counts()
    counts.add(words, lengths, np.array([5, 2, 3, 1]))
    model = mixing.untrained(counts.tables)
    mixing.learn_online(model, words, lengths)
    # All first bytes of a word, each followed by a space, and the end sign.
    single = np.array([b for b in range(256) if b not in (32, *range(9, 14)) and not 65 <= b <= 90], np.uint8)
    scores = mixing.word_scores(model, single, np.ones(len(single), np.int64))
    assert (np.exp(scores).sum(axis=0) < 1).all() and (scores < 0).all()
    seen, other = (mixing.word_scores(model, np.frombuffer(w, np.uint8), np.array([3])) for w in (b"the", b"qzx"))
    assert (seen > other).all()
    both = mixing.word_scores(model, words, lengths)
    assert np.allclose(both[0], seen[0]) and math.isfinite(mixing.text_score(both, np.zeros(4)))


@pytest.mark.parametrize("texts", [4, 5])
@pytest.mark.parametrize("limit", ["BLOCK_DOCS", "BLOCK_TOKENS"])
def test_context_counts_are_written_when_the_last_block_is_full(monkeypatch, limit, texts):
    monkeypatch.setattr(mixing, limit, {"BLOCK_DOCS": 2, "BLOCK_TOKENS": 6}[limit])
    monkeypatch.setattr(mixing, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 3)))
    batch = pa.RecordBatch.from_pydict({
        "text": ["two words"] * texts, "train": [True] * texts, "key": list(range(texts))})
    rows = [r for out in mixing._gather(1)(iter([batch])) for r in out.to_pylist()]
    assert len({r["block"] for r in rows if r["kind"] == "texts"}) == -(-texts // 2)
    for context in range(mixing.CONTEXTS):
        own = [r for r in rows if r["kind"] == "contexts" and r["block"] == context]
        # two and a space, words and a space, the end
        assert sum(mixing._unpressed(r["a"], np.int64).sum() for r in own) == texts * 11


def test_blends_sum_to_at_most_one():
    words, lengths = np.frombuffer(b"thetheyof", np.uint8), np.array([3, 4, 2, 0])
    counts = np.array([5, 2, 3, 1])
    tables = mixing.Counts()
    tables.add(words, lengths, counts)
    model = mixing.untrained(tables.tables)
    sums = np.exp(mixing.blends(mixing.word_scores(model, words, lengths), counts, 11, 4)).sum(axis=0)
    # All words of one or two of these letters that were not met.
    letters = b"aehotyzq"
    new = [bytes(w) for n in (1, 2) for w in product(letters, repeat=n) if bytes(w) != b"of"]
    bits = mixing.word_scores(model, np.frombuffer(b"".join(new), np.uint8), np.array([len(w) for w in new]))
    unmet = mixing.blends(bits, np.zeros(len(new), np.int64), 11, 4)
    assert (sums + np.exp(unmet).sum(axis=0) <= 1).all()
    # A longer unmet word costs more, without end.
    costs = [mixing.blends(mixing.word_scores(model, np.frombuffer(b"q" * n, np.uint8), np.array([n])), np.zeros(1), 11, 4) for n in (5, 50, 500)]
    assert (costs[1] < 5 * costs[0]).all() and (costs[2] < 5 * costs[1]).all()


def test_weights_are_learned_from_every_training_token():
    dice = random.Random(7)
    many = ["".join(dice.choice("aeint") for _ in range(dice.randrange(1, 7))) for _ in range(300)]
    words, lengths = np.frombuffer("".join(many).encode(), np.uint8), np.array([len(w) for w in many])
    tokens = np.array([dice.randrange(300) for _ in range(100_000)])
    counts = mixing.Counts()
    counts.add(words, lengths, np.bincount(tokens, minlength=300))
    model, seen = mixing.learn_block(counts.tables, words, lengths, tokens)
    symbols, sizes = mixing.symbols_of(words, lengths)
    bits = np.add.reduceat(mixing.CODE.length[symbols], np.cumsum(sizes) - sizes)
    assert seen.by_node.sum() == seen.by_gate.sum() == bits[tokens].sum()
    learned, plain = mixing.untrained(counts.tables), mixing.untrained(counts.tables)
    learned.by_node, learned.by_gate = model.by_node, model.by_gate
    both = [mixing.word_scores(m, words, lengths)[tokens].sum(axis=0) for m in (learned, plain)]
    assert (both[0] > both[1]).all()
    assert mixing.learn_block(counts.tables, words, lengths, tokens[:0]) is None


def test_folding_and_exceptions():
    lexicon = toxicity.Lexicon({"idiot": 3.0, "trash": 3.0}, ("trash can",))
    matcher = toxicity.Matcher(lexicon)
    for text in ("an idiot", "IDIOT!!", "1d10t", "ídïot", "іdіоt here", "idiots", "(id!ot)"):
        assert matcher.features(text)[0] == 3.0, text
    for text in ("", "a trash can", "notidiot", "12 10", "!!! ???"):
        assert matcher.features(text)[0] == 0.0, text
    assert matcher.features("trash in a trash can")[0] == 3.0
    assert matcher.score("") == matcher.score("fine words") < matcher.score("trash " + "word " * 500) < matcher.score("trash")


def test_language_backoff():
    table = lambda *rows: np.log(np.array(rows))
    model = langid.LanguageModel(
        ["de", "en"], {"the": 0, "und": 1}, table([0.01, 0.6], [0.6, 0.01]),
        {"<sch": 0, "th": 1, "x": 2}, table([0.5, 0.1], [0.1, 0.5], [0.2, 0.3]))
    found = langid.Identifier(model)
    assert found.predict("The the")[0] == "en" and found.predict("und")[0] == "de"
    assert found.predict("Schnee")[0] == "de" and found.predict("moth")[0] == "en" and found.predict("x")[0] == "en"
    assert found.predict("") == found.predict("12 !?") == ("und", 0.0)


@pytest.mark.parametrize("html, text", [
    ("", ""), ("<p>a<p>b", "a\n\nb"), ("<ul><li>x<li>y</ul>", "- x\n- y"), ("<ol start=9><li>x<li>y</ol>", "9. x\n10. y"),
    ("a<br>b", "a\nb"), ("<div>a</div><div>b</div>", "a\nb"), ("a <b> c</b>\n d", "a c d"),
    ("<table><tr><td>aa<td>b<tr><td>c<td>dd</table>", "aa  b\nc   dd"), ("<pre>x\n  y</pre>", "x\n  y"),
    ("<title>t</title><script>s</script><p hidden>h</p><p style='display: none'>n</p>v", "v"),
    ("<ul><li>a<ul><li>b</ul></ul>", "- a\n  - b"), ("</p></table><td>x", "x"), ("<" * 9, "<" * 9),
])
def test_rendering(html, text):
    assert rendered(html) == text


def test_contexts_reach_into_the_word_before():
    words, lengths = np.frombuffer(b"ofthetorun", np.uint8), np.array([2, 3, 2, 3, 0])
    index, per_text = np.array([0, 1, 4, 2, 3, 4] * 50), np.full(100, 3)
    pairs = mixing.pairs_of(index, per_text)
    own, before = mixing._unpaired(pairs)
    assert own.tolist() == index.tolist() and before.tolist() == [-1, 0, 1, -1, 2, 3] * 50
    spelled = mixing.Spelled(words, lengths)
    # "e" of "the" after "of", after "to", and in a word of its own
    slots = np.array([[s[2] for s in mixing.context_slots(spelled, np.array([1]), np.array([b]))[2]] for b in (0, 2, -1)])
    assert [len(set(column)) for column in slots.T] == [1, 1, 2, 3, 1, 3]
    counts = mixing.Counts()
    counts.add(words, lengths, *np.unique(pairs, return_counts=True)[::-1])
    model, _ = mixing.learn_block(counts.tables, words, lengths, index, pairs)
    learned = mixing.untrained(counts.tables)
    learned.by_node, learned.by_gate = model.by_node, model.by_gate
    met, unmet = mixing.word_scores(learned, words, lengths, mixing.pairs_of(np.array([0, 1, 2, 1]), np.array([2, 2])))[[1, 3]]
    assert (met > unmet + 1).all()


def test_each_bit_is_predicted_without_its_own_count():
    words, lengths = np.frombuffer(b"q", np.uint8), np.array([1])
    counts = mixing.Counts()
    counts.add(words, lengths, np.array([1]))
    symbols, _, slots = mixing.context_slots(mixing.Spelled(words, lengths), np.array([0]), np.array([-1]))
    assert not mixing._bits(symbols, slots, mixing.learner(counts.tables))[3].any()
    assert (mixing._bits(symbols, slots, mixing.untrained(counts.tables))[3] != 0).all()


def test_words_encoded_many_at_a_time_are_those_of_each_alone():
    from gapwatch.llm import chunks
    from gapwatch.llm.queries import tokenizer_path

    tokenizer = chunks.tokenizer_of(tokenizer_path())
    given = ["The", "the.", "WORD'", "don't", "it's.", "...", "a1", "<|endoftext|>", "Iß\u0130", "x" * 300, "<", "end<|", "caf\u00e9!", "ab\x7f"]
    alone = [chunks.packed(e.ids) for e in tokenizer.encode_batch_fast(given, add_special_tokens=False)]
    words = packing.WordIds(tokenizer, most=3, at_once=2)
    assert list(words(given)) == alone and list(words(given[::-1])) == alone[::-1]
    asked = []
    counting = SimpleNamespace(
        get_vocab=tokenizer.get_vocab, get_vocab_size=tokenizer.get_vocab_size, model=tokenizer.model,
        encode_batch_fast=lambda x, **kw: asked.append(len(x)) or tokenizer.encode_batch_fast(x, **kw))
    many = ["Word" + chr(97 + i) + sign for i in range(26) for sign in ("", ".", ",")]
    assert list(packing.WordIds(counting)(many)) == [chunks.packed(e.ids) for e in tokenizer.encode_batch_fast(many, add_special_tokens=False)]
    assert sum(asked) == 3  # a line of words and two signs


def test_words_of_plain_chunks_are_those_of_the_pattern():
    import regex
    from gapwatch.llm import automaton, chunks

    assert chunks.plain_words("Don") == ("don",) and chunks.plain_words("so!?'") == ("so", "!?'")
    assert all(chunks.plain_words(c) is None for c in ("don't", "...", "a1", "caf\u00e9", "<|endoftext|>", "a\x00", ""))
    dice = random.Random(5)
    for _ in range(2000):
        chunk = "".join(dice.choice("abSTdm'.<_1|") for _ in range(dice.randrange(1, 7)))
        assert (chunks.plain_words(chunk) or None) in (None, tuple(regex.findall(automaton.WORDS, chunk.lower())))


def test_accented_words_go_to_the_library_a_line_at_a_time_and_keep_their_ids():
    from gapwatch.llm import chunks

    tokenizer = chunks.tokenizer_of(tokenizer_path())
    asked = []
    plain = SimpleNamespace(encode_batch_fast=lambda x, **kw: asked.append(len(x)) or chunks.words_only(tokenizer).encode_batch_fast(x, **kw))
    many = [w + s for w in ("Été", "straße", "µm", "Word", "naïve" * 60, *(f"è{chr(97 + i)}" for i in range(26))) for s in ("", ".", ",'s")]
    alone = [chunks.packed(e.ids) for e in tokenizer.encode_batch_fast(many, add_special_tokens=False)]
    assert list(packing.WordIds(tokenizer, plain)(many)) == alone and asked == [1]
    odd = ["été", "İx", "ΟΣ", "don't", "日本", "a²", "×", "<|endoftext|>", "ſo"]
    assert [chunks.latin_word(c) for c in odd] == [("", "")] * len(odd)
    alone = [chunks.packed(e.ids) for e in tokenizer.encode_batch_fast(odd, add_special_tokens=False)]
    assert list(packing.WordIds(tokenizer, plain)(odd)) == alone
