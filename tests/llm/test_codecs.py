"""Simple-8b, BPE and Feistel against the libraries and by round trips; no Spark."""

from __future__ import annotations

import datetime

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cairnflow.llm.bpe import WordBPE
from cairnflow.llm.pii import Feistel, Pseudonyms, luhn_digit
from cairnflow.llm.simple8b import BLOCK_IDS, pack, read_block, read_segment, unpack, write_segment
from cairnflow.llm.token_output import _Ids

KEY = b"a key of the tests"
BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
PIECES = ["a", " ", "  ", "\n", "\t", "b1", "'s", "don't", "é", "\xa0", "　", "!!", "\x1c", "\x85", "<|endoftext|>", "<|startoftext|>", "字", "1", "​", "\r\n", "x", "'LL", "́", "Σ", "İ", "aaaa", "ing", "²", "\x00", "ß", "😀"]
texts = st.lists(st.sampled_from(PIECES), max_size=14).map("".join) | st.text(alphabet=st.characters(codec="utf-8"), max_size=30)


@given(st.lists(st.integers(0, 2**64 - 1) | st.integers(0, 60_000) | st.integers(0, 1), max_size=300))
@settings(max_examples=60, deadline=None)
def test_simple8b_round_trip(ids):
    words, blocks, wide = pack(np.array(ids, dtype=np.uint64))
    assert unpack(words, blocks, len(ids), wide).tolist() == ids


def test_segments_and_blocks():
    ids = np.random.default_rng(1).integers(0, 50_257, 3 * BLOCK_IDS + 7).astype(np.uint64)
    data = write_segment([7, None, 9], [len(ids) - 2, 0, 2], ids)
    docs, counts, back = read_segment(data)
    assert docs == [7, None, 9] and counts.tolist() == [len(ids) - 2, 0, 2] and (back == ids).all()
    for k in range(4):
        assert (read_block(data, k) == ids[k * BLOCK_IDS : (k + 1) * BLOCK_IDS]).all()
    with pytest.raises(ValueError):
        read_segment(b"xxxx" + data[4:])


def test_byte_ids_equal_the_library():
    library, own = Tokenizer.from_file(BYTE), _Ids(BYTE, remember=5)

    @given(texts)
    @settings(max_examples=300, deadline=None)
    def check(text):
        assert np.frombuffer(own.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids

    check()


def test_word_ids_and_decoding_equal_the_library():
    library, own = Tokenizer.from_file(WORD), WordBPE(WORD, remember=5)

    @given(texts)
    @settings(max_examples=300, deadline=None)
    def check(text):
        ids = np.frombuffer(own.encode([text])[0], "<u4").tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)

    check()


@pytest.mark.parametrize("word", ["a" * 3000, "thing" * 700, "ß" * 999])
def test_long_words(word):
    assert np.frombuffer(WordBPE(WORD).encode([word])[0], "<u4").tolist() == Tokenizer.from_file(WORD).encode(word, add_special_tokens=False).ids


@pytest.mark.parametrize("size", [1, 2, 10, 97, 1000])
def test_feistel_is_a_permutation(size):
    f = Feistel(b"key")
    assert sorted(f.permute("k", size, i) for i in range(size)) == list(range(size))
    assert all(f.permute("k", size, f.permute("k", size, i), back=True) == i for i in range(size))


def test_pseudonyms_keep_formats_and_links():
    p, back = Pseudonyms(KEY), Pseudonyms(KEY, back=True)
    text = "a 4111-1111-1111-1111 b 4111111111111111 c 10.0.0.255 d 2024-02-29 e 31/12/1999 f Ann.Lee7@ex.org g (415) 555-2671 h 123-45-6789"
    new, kinds, starts, _ = p.replace(text)
    assert kinds == ["card", "card", "ip", "iso_date", "date", "email", "phone", "ssn"]
    assert new != text and back.restore(*p.replace(text))[0] == text and len(starts) == 8
    cards = [new[starts[0] : starts[0] + 19], new[starts[1] : starts[1] + 16]]
    assert cards[0].replace("-", "") == cards[1] and luhn_digit(cards[1][:-1]) == cards[1][-1]
    datetime.date.fromisoformat(new[starts[3] : starts[3] + 10])


def test_long_local_parts_and_each_format_turn_back():
    p, back = Pseudonyms(KEY), Pseudonyms(KEY, back=True)
    long = "aB3" * 3500 + "@ex.org"
    new, kinds, *_ = p.replace(long)
    assert kinds == ["email"] and new != long and len(new) == len(long) and back.restore(*p.replace(long))[0] == long
    many = " ".join(f"n{k}@ex.org 10.0.0.{k % 250}" for k in range(3000))
    assert back.restore(*p.replace(many))[0] == many
    for text in ("12/31/1999", "31/12/1999", "02.03.2004", "1999-12-31", "123-45-6789", "899-99-9999", "(415) 555-2671", "10.1.2.3", "4111 1111 1111 1111"):
        new, kinds, *_ = p.replace(text)
        assert len(kinds) == 1 and new != text and back.restore(*p.replace(text))[0] == text, text
    day = {datetime.date.fromisoformat(p.replace("1999-12-31")[0])}
    first, second = p.replace("31/12/1999")[0], p.replace("12/31/1999")[0]
    assert day == {datetime.datetime.strptime(first, "%d/%m/%Y").date()} == {datetime.datetime.strptime(second, "%m/%d/%Y").date()}


def test_social_security_numbers_are_permuted_among_valid_ones():
    p = Pseudonyms(KEY)
    for k in range(1, 2000):
        new = p.ssn(f"{1 + k % 665:03}-{1 + k % 99:02}-{k:04}")
        assert new and p.ssn(new) is not None


@pytest.mark.parametrize("text", ["", "no numbers", "4111-1111-1111-1112", "999.1.1.1", "2023-02-30", "000-00-0000", "666-12-3456", "901-12-3456", "123-00-4567", "123-45-0000", "13/31/1999", "v1.2.3.4", "12345", "@", "1.2.3", "rows 100-2000", "1 200 300 400 people", "155-0100", "0000-00-00"])
def test_what_is_not_validated_stays(text):
    assert Pseudonyms(KEY).replace(text) == (text, [], [], [])


@pytest.mark.parametrize("text", ["4111 1111 1111 1111 12/27", "4111111111111111 737", "order 12 4111111111111111", "1234 4111 1111 1111 1111", "12 34 4111 1111 1111 1111 999", "4111 1111 1111 1111 12@b.co", "4111-1111-1111-1111 4111 1111 1111 1111"])
def test_cards_next_to_other_numbers(text):
    own = Pseudonyms(KEY).card("4111111111111111")
    new, kinds, starts, lengths = Pseudonyms(KEY).replace(text)
    assert "card" in kinds and "4111" not in new
    assert all("".join(c for c in new[s : s + 19] if c.isdigit()).startswith(own) for s, kind in zip(starts, kinds, strict=True) if kind == "card")
    assert Pseudonyms(KEY, back=True).restore(new, kinds, starts, lengths)[0] == text


def test_a_number_beside_a_card_is_no_part_of_it():
    own = Pseudonyms(KEY).card("4111111111111111")
    both = [n for n in range(100, 1000) if luhn_digit(f"4111111111111111{n}"[:-1]) == str(n)[-1]]
    assert both and all(Pseudonyms(KEY).replace(f"4111111111111111 {n}")[0] == f"{own} {n}" for n in both)


def test_values_among_groups_that_are_no_card():
    p, back = Pseudonyms(KEY), Pseudonyms(KEY, back=True)
    assert p.replace("id 12345 2024-01-02")[1] == ["iso_date"] and p.replace("id 123 4567 555-123-4567")[1] == ["phone"]
    assert p.replace("4111 1111 1111 1112") == ("4111 1111 1111 1112", [], [], [])
    for n in range(3000):
        for text in (f"{n:05} 2024-01-02", f"{n:04} 4111 1111 1111 1111", f"{n} 41111 11111 111111 {n}"):
            assert back.restore(*p.replace(text))[0] == text, text


def test_one_value_has_one_pseudonym_among_any_number_of_loose_digits():
    p, back = Pseudonyms(KEY), Pseudonyms(KEY, back=True)
    own = p.card("4111 1111 1111 1111")
    for lines in (1, 30, 300):
        text = "\n".join(f"{3000 + 7 * k} 4111 1111 1111 1111 {k % 10}" for k in range(lines))
        new, kinds, starts, lengths = p.replace(text)
        assert new.count(own) >= 0.8 * lines  # beside other digits, some lines hold another valid number before it
        assert all(new[s : s + n] == own for s, n, k in zip(starts, lengths, kinds, strict=True) if k == "card" and text[s : s + n] == "4111 1111 1111 1111")
        assert back.restore(new, kinds, starts, lengths)[0] == text
    long = bytes(64) + b"one"
    assert Pseudonyms(long).card("4111111111111111") != Pseudonyms(long[:64] + b"two").card("4111111111111111")


def test_dates_of_all_years_and_numbers_of_all_forms():
    p, back = Pseudonyms(KEY), Pseudonyms(KEY, back=True)
    for text in ("1850-03-04", "0001-01-01", "9999-12-31", "31.12.1899", "29/02/2400", "+1 (017) 555-7713", "+49 171 555 0100", "0171 555 1234", "555-0100", "+1 212 555 0100"):
        new, kinds, *_ = p.replace(text)
        assert len(kinds) == 1 and new != text and p.replace(new)[1] == kinds and back.restore(*p.replace(text))[0] == text, text
    digits = lambda t: "".join(c for c in p.replace(t)[0] if c.isdigit())
    assert digits("(212) 555-0100") == digits("212-555-0100") == digits("+1 212 555 0100")[1:]
    seen = {p.replace(f"{y}-{m:02}-{d:02}")[0] for y in (1899, 1900, 2099, 2100) for m in range(1, 13) for d in range(1, 29)}
    assert len(seen) == 4 * 12 * 28
