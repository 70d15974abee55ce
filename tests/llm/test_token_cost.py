"""Work that the encoder and the Re-Pair grammar do not do twice."""
import numpy as np

from ordermill.llm import tokenfile, tokens


def test_words_are_looked_up_without_their_marks(monkeypatch):
    own = tokens.Encoder(tokens.default_vocabulary())
    asked = []
    encoded = own._encoded
    monkeypatch.setattr(own, "_encoded", lambda missing, plain: asked.extend(missing) or encoded(missing, plain))
    texts = ["The cat, the dog; cat. Été! été? 3.5 a.b.c", "cat: dog", "it's x1, (dog).", "é, Ñ.", "<|endoftext|>, cat,", None, "", "²,"]
    got = own.encode(texts)
    assert [g.tolist() for g in got] == own._ids([t or "" for t in texts])
    plain = own.encode(["dog, cat. dog; cat! dog?"])
    asked.clear()
    own.encode(["cat, dog. cat; dog! cat?"])
    assert asked == [] and len(plain) == 1


def test_pairs_that_occur_once_are_not_listed():
    ids = np.array([1, 2, 3, 1, 2, 4, 5, 6, 7, 1, 2])
    last = np.zeros(len(ids), bool)
    last[[4, 10]] = True
    state = tokenfile.Sequence(ids, last)
    assert sorted(state.places[:state.used].tolist()) == [0, 3, 9]
    symbols, ends, rules = tokenfile.compress(ids, last, 10)
    assert symbols.tolist() == [10, 3, 10, 4, 5, 6, 7, 10] and rules.tolist() == [[1, 2]]
    assert np.flatnonzero(ends).tolist() == [2, 7]


def test_words_are_cut_from_every_ascii_mark_and_learned_many_at_a_time(monkeypatch):
    own = tokens.Encoder(tokens.default_vocabulary())
    texts = ["dog$$$ cat### (bird) a_b x=y tom's 'tis o'-s x'll% don't- \"q\" e-mail@x.org/~a", "straße*** été[1] naïve{é} ñ|ñ <|endoftext|>",
             "été`` İx& Σσ$ a≠b ño^ \x01 a\x01$", " ".join(f"w{chr(97 + i % 26)}{'zq' * (i % 7)}$" for i in range(700)), None]
    for part in (texts, *[[t] for t in texts]):
        assert [g.tolist() for g in own.encode(part)] == own._ids([t or "" for t in part])
    own.encode(["dog$$$ cat%%% bird&&&"])
    monkeypatch.setattr(own, "_encoded", lambda missing, plain: 1 / 0)      # all known by now
    again = "cat$$$ bird%%% dog&&&"
    assert own.encode([again])[0].tolist() == own._ids([again])[0]


def test_a_full_memo_begins_again_with_the_same_ids(monkeypatch):
    monkeypatch.setattr(tokens, "MEMO_PIECES", 5)
    own = tokens.Encoder(tokens.default_vocabulary())
    texts = ["the cat, a dog", "a bird; the dogΣ$ dog", "one two three four five six the cat", "cat dog$ bird"]
    for _ in range(2):
        for t in texts:
            assert own.encode([t])[0].tolist() == own._ids([t])[0]


def test_the_grammar_takes_few_rounds_and_leaves_no_pair(monkeypatch):
    draw, rounds = np.random.default_rng(3), []
    ids = np.minimum(draw.zipf(1.3, 20000), 900)
    last = np.zeros(len(ids), bool)
    last[np.append(draw.choice(len(ids) - 1, 50, replace=False), len(ids) - 1)] = True
    chosen = tokenfile.Sequence.chosen
    monkeypatch.setattr(tokenfile.Sequence, "chosen", lambda self: rounds.append(1) or chosen(self))
    symbols, ends, rules = tokenfile.compress(ids, last, 1000)
    few = len(rounds)
    monkeypatch.setattr(tokenfile, "ROUND_PART", 2)
    tokenfile.compress(ids, last, 1000)
    assert few < len(rounds) - few
    seen, i = set(), 0
    while i < len(symbols) - 1:                            # a pair that overlaps itself counts once
        if not ends[i]:
            assert (pair := (symbols[i], symbols[i + 1])) not in seen
            seen.add(pair)
            if i + 2 < len(symbols) and symbols[i] == symbols[i + 1] == symbols[i + 2] and not ends[i + 1]:
                i += 1
        i += 1
