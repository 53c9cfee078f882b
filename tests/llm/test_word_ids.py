"""Ids of words with tables of remembered words and parts that are too small for the text."""

import struct

import public_tokenizers

from pairwright.llm.packing import WordIds, load_tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = ["Plain plain, PLAIN!! (plain) it's", "Été über, é 3.5% <s> 12,", "", "... , plain-word Word\tword;\nword", "a b c d e f a b c"]


def test_small_tables_give_the_ids_of_the_whole_tokenizer():
    for words, parts in ((1, 1), (3, 2), (100, 100)):
        ids = WordIds(PATH, words, parts)
        for text in TEXTS * 2:
            whole = load_tokenizer(PATH).encode(text, add_special_tokens=False).ids
            assert ids(text) == struct.pack(f"<{len(whole)}I", *whole)


def test_words_share_their_parts():
    ids = WordIds(PATH)
    ids("Plain plain, PLAIN!! plain")
    assert set(ids.parts) == {b"", b"plain", b",", b"!!"}
