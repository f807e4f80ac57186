"""Token records and sentence pieces against the libraries, with texts made to be awkward."""
import json
import random
import re
import time
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tidemark.llm import sentencepieces, token_records

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
PARTS = [" ", "  ", "\n", "\t", "a", "the", "'s", "<|endoftext|>", "é", "2", "²", ".", "!?", "\u2003", "ñ", "\u0301", "😀", "\r\n", "_", "ń", "я", "漢", "\x85", "▁", "\x00", "<s>"]


def awkward(seed, n=4000):
    random.seed(seed)
    made = ["".join(random.choices(PARTS, k=random.randrange(1, 14))) for _ in range(n)]
    return ["", " ", "\n", "a" * 5000, " " * 37, "the" * 400, *made]


def test_encoder_equals_the_library():
    texts, own = awkward(1), token_records.Encoder(BYTE_BPE)
    wanted = [e.ids for e in Tokenizer.from_file(BYTE_BPE).encode_batch(texts, add_special_tokens=False)]
    got = [np.frombuffer(x, "<u2").tolist() for at in range(0, len(texts), 64) for x in own.encode(texts[at : at + 64])]
    assert got == wanted


def test_pieces_equal_the_library():
    texts, own = awkward(2), sentencepieces.table(PIECES)
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    ids = library.encode(texts)
    assert [own.encode(t) for t in texts] == ids
    assert [own.decode(i) for i in ids] == [library.decode(i) for i in ids]
    random.seed(3)
    odd = [[random.randrange(3, 600) for _ in range(random.randrange(1, 9))] for _ in range(2000)]
    assert [own.decode(i) for i in odd] == [library.decode(i) for i in odd]


def test_records_round_trip(spark, tmp_path):
    texts = [*awkward(4, 300), None]
    rows = [(i // 2 if i % 7 else None, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as shard", "2 as ids")
    index = token_records.write_records(docs.repartition(3), str(tmp_path), BYTE_BPE)
    back = token_records.read_records(token_records.with_start(index), str(tmp_path), ("doc_id", "start", "n_tokens")).collect()
    library = Tokenizer.from_file(BYTE_BPE)
    wanted = [[*library.encode(t or "", add_special_tokens=False).ids, 0] for _, t in rows]
    key = lambda k: -1 if k is None else k
    assert sorted((key(r["doc_id"]), r["ids"]) for r in back) == sorted((key(k), w) for (k, _), w in zip(rows, wanted))
    at = 0
    for r in sorted(back, key=lambda r: r["start"]):
        assert r["start"] == at and r["n_tokens"] == len(r["ids"])
        at += len(r["ids"])
    ordered = [key(r["doc_id"]) for r in sorted(back, key=lambda r: r["start"])]
    assert ordered == sorted(ordered)
    crc = {r["c"]: r["ids"] for r in spark.createDataFrame([([1, 70000],), ([],)], "ids array<int>").select("ids", token_records.ids_crc32().alias("c")).collect()}
    assert crc == {zlib.crc32(np.array(v, "<u4").tobytes()): v for v in ([1, 70000], [])}


def test_damaged_records_raise():
    raw = token_records.frame(b"\x02\x01\x00")
    assert token_records.unframe(raw) == b"\x02\x01\x00"
    for k in (0, 9, 13, len(raw) - 1):
        with pytest.raises(ValueError):
            token_records.unframe(raw[:k] + bytes([raw[k] ^ 1]) + raw[k + 1 :])


def test_no_documents(spark, tmp_path):
    none = spark.createDataFrame([], "doc_id long, text string")
    index = token_records.write_records(none, str(tmp_path), BYTE_BPE)
    assert token_records.read_records(token_records.with_start(index), str(tmp_path), ("doc_id",)).count() == 0
    assert sentencepieces.decode(sentencepieces.encode(none, PIECES), PIECES).count() == 0


def test_pieces_by_spark_with_nulls_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (2, "", "x"), (3, " a\n" * 5000, "x")], "doc_id long, text string, ids string")
    got = sentencepieces.decode(sentencepieces.encode(docs, PIECES), PIECES).orderBy("doc_id").collect()
    assert [(r["doc_id"], r["decoded"], len(r["ids"]) > 0) for r in got] == [(1, "", False), (2, "", False), (2, "", False), (3, " a\n" * 5000, True)]


def test_a_file_with_other_cuts_is_encoded_whole(tmp_path):
    import json

    spec = json.load(open(BYTE_BPE, encoding="utf-8"))
    spec["pre_tokenizer"]["add_prefix_space"] = True
    path = str(tmp_path / "other.json")
    json.dump(spec, open(path, "w", encoding="utf-8"))
    texts, own = awkward(2, 300), token_records.Encoder(path)
    assert not own.cuts and token_records.Encoder(BYTE_BPE).cuts
    wanted = [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u2").tolist() for x in own.encode(texts)] == wanted


def test_memories_that_overflow_change_nothing(monkeypatch):
    monkeypatch.setattr(token_records, "REMEMBERED", 60)
    monkeypatch.setattr(sentencepieces, "REMEMBERED", 60)
    texts = awkward(3, 600)
    library, own = Tokenizer.from_file(BYTE_BPE), token_records.Encoder(BYTE_BPE)
    got = [np.frombuffer(x, "<u2").tolist() for at in range(0, len(texts), 16) for x in own.encode(texts[at : at + 16])]
    assert got == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    pieces = sentencepieces.PrefixTable(PIECES)
    assert [pieces.encode(t) for t in texts] == sentencepiece.SentencePieceProcessor(model_file=PIECES).encode(texts)


def test_decoding_needs_a_fraction_of_the_prefix_table():
    def kept(make):
        tracemalloc.start()
        made = make(PIECES)
        size = tracemalloc.get_traced_memory()[0]
        tracemalloc.stop()
        return made, size

    kept(sentencepieces.PieceTexts)  # imports
    (texts, light), (table, heavy) = kept(sentencepieces.PieceTexts), kept(sentencepieces.PrefixTable)
    assert light < heavy / 2 and not hasattr(texts, "automaton")
    ids = [table.encode(t) for t in awkward(4, 500)] + [[table.byte[200], 300], []]
    assert [texts.decode(i) for i in ids] == [table.decode(i) for i in ids]


def test_new_words_go_to_the_model_together():
    library, own = Tokenizer.from_file(BYTE_BPE), token_records.Encoder(BYTE_BPE)
    asked, many = [], own.words

    class Noted:
        def encode_batch_fast(self, parts, **options):
            asked.extend(parts)
            return many.encode_batch_fast(parts, **options)

    own.words = Noted()
    random.seed(5)
    word = lambda: random.choice([" ", "\n"]) + "".join(random.choices("abcdefghijklmnàéÿßÑ", k=random.randrange(1, 12)))
    texts = ["".join(word() for _ in range(400)) for _ in range(20)]
    got = [np.frombuffer(x, "<u2").tolist() for x in own.encode(texts)]
    assert got == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert 0 < len(asked) <= len(own.pieces) / token_records.TOGETHER + 1


@pytest.mark.parametrize("change", ["ignore_merges", "crossing"])
def test_models_that_join_words_see_each_alone(tmp_path, change):
    spec = json.load(open(BYTE_BPE, encoding="utf-8"))
    if change == "crossing":
        spec["model"]["vocab"]["eĠ"] = len(spec["model"]["vocab"]) + 1
        spec["model"]["merges"].insert(0, ["e", "Ġ"] if isinstance(spec["model"]["merges"][0], list) else "e Ġ")
    else:
        spec["model"]["ignore_merges"] = True
    path = str(tmp_path / "other.json")
    json.dump(spec, open(path, "w", encoding="utf-8"))
    own = token_records.Encoder(path)
    assert own.cuts and own.words is None
    texts = [" the one the other\nwhere we are", *awkward(6, 200)]
    assert [np.frombuffer(x, "<u2").tolist() for x in own.encode(texts)] == [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]


def test_latin_texts_are_cut_without_the_far_marks():
    own, library = sentencepieces.PrefixTable(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    far = [c for p in own.id for c in p if c > "\uffff"]
    assert far and max(own.narrow_unit.pattern) <= "\xff"
    texts = [*awkward(7, 500), " ¡a.b \n\n¿é ", *("".join(random.choices([*far, *PARTS, *"…–’.,a"], k=20)) for _ in range(500))]
    assert [own.encode(t) for t in texts] == library.encode(texts)
    narrow = [" " + t.replace("▁", " ") for t in texts if max(t, default="") <= "\xff"]
    assert len(narrow) > 20 and [own.narrow_unit.findall(t) for t in narrow] == [own.unit.findall(t) for t in narrow]
    before = len(own.units)
    own.encode("tulpe"), own.encode("“ tulpe")  # one word, remembered once
    assert len(own.units) == before + 2


def test_pieces_that_hold_line_ends_or_no_far_marks():
    for pieces, text, wanted in (
        (["▁a", "b"], " a. b\n c", [" a.", " b", "\n", " c"]),
        (["▁a", ".", "😀"], " a.b😀.c\n", [" a", ".b", "😀.c", "\n"]),
        (["▁a", "a\n"], " a\nb a", [" a\nb", " a"]),
    ):
        assert [sentencepieces.units_of(pieces)[0].findall(text)] == [wanted]


def test_the_large_memory_is_asked_once_for_each_piece_of_a_batch():
    asked = []

    class Noted(dict):
        def get(self, piece):
            asked.append(piece)
            return super().get(piece)

        def __getitem__(self, piece):
            asked.append(piece)
            return super().__getitem__(piece)

        def __contains__(self, piece):
            asked.append(piece)
            return super().__contains__(piece)

    library, own = Tokenizer.from_file(BYTE_BPE), token_records.Encoder(BYTE_BPE)
    own.pieces = Noted()
    texts = awkward(8, 60) + ["one two\nthree, two one"] * 3
    wanted = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    for _ in range(2):  # new pieces, then known ones
        asked.clear()
        assert [np.frombuffer(x, "<u2").tolist() for x in own.encode(texts)] == wanted
        assert 0 < len(asked) == len(set(asked)) == len(own.pieces)


L = token_records.LATIN
LATIN_PIECE = re.compile(rf"[ \n]*[^ \n{L}]*[{L}]+|[ \n]*[^ \n{L}]+|[ \n]+")


def test_known_pieces_cost_less_than_making_each_a_string():
    random.seed(9)
    words = ["".join(random.choices("abcdefghijklmnàéÿßÑ", k=random.randrange(2, 12))) for _ in range(20000)]
    texts = [" ".join(random.choices(words, k=500)) for _ in range(1500)]
    own = token_records.Encoder(BYTE_BPE)
    wanted = [e.ids for e in Tokenizer.from_file(BYTE_BPE).encode_batch_fast(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u2").tolist() for x in own.encode(texts)] == wanted
    distinct = list({p for t in texts for p in LATIN_PIECE.findall(t)})
    known = dict(zip(distinct, own._each(distinct)))

    def least(run):
        took = []
        for _ in range(7):
            began = time.process_time()
            run()
            took.append(time.process_time() - began)
        return min(took)

    assert least(lambda: list(own.encode(texts))) < 0.75 * least(lambda: [b"".join(map(known.__getitem__, LATIN_PIECE.findall(t))) for t in texts])


def test_pieces_begin_where_patterns_say():
    blanks = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
    texts = [*awkward(10, 800), "", "×é÷À×", "é", "a×b÷cÿ", "\u00c3\u0083", "Ã \n", "\u0180\u00df\u1403", ""]
    for marks in ([i % 3 > 0 for i in range(len(texts))], [False] * len(texts), [True] * len(texts)):
        raw = [t.encode() for t in texts]
        begins = token_records.piece_begins(np.frombuffer(b"".join(raw), np.uint8), np.array(list(map(len, raw))), np.array(marks))
        wanted = [p.encode() for t, mark in zip(texts, marks) for p in (LATIN_PIECE if mark else blanks).findall(t)]
        ends = [*begins[1:].tolist(), len(b"".join(raw))]
        assert [b"".join(raw)[a:b] for a, b in zip(begins, ends)] == wanted
    own = token_records.Encoder(BYTE_BPE)
    assert list(own.encode([])) == [] and list(own.encode(["", ""])) == [b"", b""]


def test_runs_hold_every_text_once(monkeypatch):
    monkeypatch.setattr(token_records, "RUN", 50)
    texts = [*awkward(11, 100), "", "x" * 500, ""]
    for some in (texts, [], [""], ["x" * 120]):
        runs = list(token_records.runs(pa.array(["before", *some], pa.string()).slice(1)))
        assert [t for run in runs for t in run] == some
        assert all(sum(len(t.encode()) for t in run[1:]) <= 50 for run in runs)
