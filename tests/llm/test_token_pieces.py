"""Pieces of texts by their bytes, the memo's numbers, and rules read in runs."""
import numpy as np

from ordermill.llm import tokenfile, tokens


def test_short_texts_are_cut_together(monkeypatch):
    own = tokens.Encoder(tokens.default_vocabulary())
    calls, encoded = [], own._encoded
    monkeypatch.setattr(own, "_encoded", lambda missing, plain: calls.append(len(missing)) or encoded(missing, plain))
    texts = [f"word{chr(97 + i % 26)} w{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}, the" for i in range(3000)]
    assert [g.tolist() for g in own.encode(texts)] == own._ids(texts)
    assert len(calls) == 1                                 # was one for every 1024 texts


def test_pieces_are_cut_where_letters_end():
    texts = ["a, b..cé$ ж- ", "", "漢_ \U00010400~ it's 3.5 \U0001f600! ́; x1,", "a, é$", " ", "z"]
    found, bounds = tokens.pieces(texts, [True, True, True, False, True, True])
    want = [["a", ",", "b", "..cé", "$", "ж", "-"], [], ["漢", "_", "\U00010400", "~", "it's", "3.5", "\U0001f600!", "́;", "x1,"],
            ["a,", "é$"], [], ["z"]]
    assert [found.to_pylist()[a:b] for a, b in zip(bounds[:-1], bounds[1:])] == want
    assert tokens.pieces([""], [True])[1].tolist() == [0, 0]


def test_ids_stay_the_same_at_every_batch_and_memo_size(monkeypatch):
    texts = ["café$ Жж-漢_ a~b", None, "", "Σ$ İx& 가 ́;", "<|endoftext|>, A\x01$", "é$ dog,dog", "가` \U00010400#"] * 3
    own = tokens.Encoder(tokens.default_vocabulary())
    want = own._ids([t or "" for t in texts])
    for characters, words in ((1, 500), (20, 3), (1 << 20, 1)):
        monkeypatch.setattr(tokens, "CHARACTERS_ABREAST", characters)
        monkeypatch.setattr(tokens, "MEMO_PIECES", words)
        for _ in range(2):
            assert [g.tolist() for g in own.encode(texts)] == want
    assert own.encode([]) == []


def test_expansions_are_laid_out_once_for_a_run_of_rules(monkeypatch):
    draw = np.random.default_rng(5)
    docs = [np.append(draw.integers(0, 40, 300), 2), np.tile([7, 9], 512)]
    block = tokenfile.Block(tokenfile.dump(docs * 4, 60))
    terminals, rules, calls, ranges = 60, block.rules, [], tokenfile.ranges
    runs = list(tokenfile.steps(rules, terminals))
    assert [r.start for r in runs] == [0, *(r.stop for r in runs[:-1])] and runs[-1].stop == len(rules)
    assert all(rules[r].max() < terminals + r.start for r in runs)
    sizes = [1] * terminals
    for a, b in rules.tolist():
        sizes.append(sizes[a] + sizes[b])
    assert tokenfile.lengths_of(rules, terminals).tolist() == sizes[terminals:]
    monkeypatch.setattr(tokenfile, "ranges", lambda *x: calls.append(1) or ranges(*x))
    assert block.all()[0].tolist() == np.concatenate(docs * 4).tolist()
    assert len(calls) == len(runs) + 1                     # was four for every level of rules
    assert tokenfile.lengths_of(np.zeros((0, 2), np.int64), terminals).tolist() == []
