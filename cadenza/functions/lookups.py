"""Small lookup tables whose values are fixed: they decide what the operators return."""

from __future__ import annotations

# The phonetic forms accepted for each item.
ACCEPTED: dict[str, list[str]] = {
    "a_letter": ["a", "ɛ"],
    "a_sound": ["æ", "ɛ", "ʌ"],
    "b_letter": ["bi", "b"],
    "b_sound": ["bʌ", "b"],
    "c_letter": ["si", "zi"],
    "c_sound": ["k", "s", "kʌ", "sʌ"],
    "d_letter": ["di"],
    "d_sound": ["dʌ", "d"],
    "e_letter": ["i"],
    "e_sound": ["ɛ", "i", "ɪ", "æ"],
    "f_letter": ["ɛf", "ɛs"],
    "f_sound": ["fʌ", "f", "v", "vʌ"],
    "g_letter": ["ji"],
    "g_sound": ["gʌ", "jʌ", "g", "j"],
    "h_letter": ["ax", "x"],
    "h_sound": ["hʌ", "h"],
    "i_letter": ["γ", "ɑ"],
    "i_sound": ["ɪ", "γ", "ɛ", "i"],
    "j_letter": ["ja"],
    "j_sound": ["jʌ", "j"],
    "k_letter": ["ka"],
    "k_sound": ["kʌ", "k"],
    "l_letter": ["ɛl"],
    "l_sound": ["l", "ʌl", "ʌ"],
    "m_letter": ["ɛm", "ɛn"],
    "m_sound": ["m", "mʌ"],
    "n_letter": ["ɛn", "ɪn", "ɛm"],
    "n_sound": ["n", "nʌ", "m"],
    "o_letter": ["o"],
    "o_sound": ["ɑ", "o", "ʌ", "γ", "ɑɹ"],
    "p_letter": ["pi"],
    "p_sound": ["pʌ", "ph", "p"],
    "q_letter": ["kyu"],
    "q_sound": ["kwʌ", "kʌ", "kw"],
    "r_letter": ["ɑɹ"],
    "r_sound": ["ɝ", "ɹʌ", "ɹ", "ʌ", "l", "ʌl"],
    "s_letter": ["ɛs"],
    "s_sound": ["s", "sʌ", "f"],
    "t_letter": ["ti"],
    "t_sound": ["tʌ", "th", "t", "pʌ"],
    "u_letter": ["yu", "y"],
    "u_sound": ["ʌ", "u", "ɑ", "ʌl", "ɝ"],
    "v_letter": ["vi"],
    "v_sound": ["v", "vʌ", "z"],
    "w_letter": ["dʌbʌlyu", "dʌbyu"],
    "w_sound": ["wʌ", "w"],
    "x_letter": ["ɛks"],
    "x_sound": ["ks"],
    "y_letter": ["wγ"],
    "y_sound": ["yʌ", "y"],
    "z_letter": ["zi", "z"],
    "z_sound": ["z", "zʌ", "v"],
}

# Characters that may stand for a character of a phonetic word (beside itself).
SUBSTITUTES: dict[str, list[str]] = {
    "b": ["v"],
    "f": ["s"],
    "l": ["w", "ɹ"],
    "m": ["n", "ŋ"],
    "n": ["m", "ŋ"],
    "s": ["f", "ʃ"],
    "v": ["z"],
    "w": ["ɹ"],
    "x": ["t"],
    "z": ["v"],
    "æ": ["ɛ"],
    "ŋ": ["n", "m"],
    "ɑ": ["ɔ", "ʌ"],
    "ɔ": ["ɑ", "ʌ"],
    "ɛ": ["æ", "ɪ"],
    "ɝ": ["ɹ"],
    "ɪ": ["ɛ"],
    "ɹ": ["w", "ʌ", "ɝ"],
    "ʃ": ["s"],
    "ʊ": ["ʌ"],
    "ʌ": ["ɔ", "ʊ"],
    "γ": ["ɑ"],
}

#: Elements that the tokeniser may find: all accepted forms.
ELEMENTS: list[str] = sorted({p for forms in ACCEPTED.values() for p in forms}, key=lambda p: (-len(p), p))

# Fixed value: characters that are dropped from phrases before words are compared.
PUNCTUATION = "[.,?!:;()\\[\\]\"'’“”]"

# Tokens of a decoder's stream.
PAD, SEPARATOR, DASH = "<pad>", "|", "-"

# Bytes of an audio header, and bytes of one millisecond of 16 kHz 16-bit audio.
HEADER_BYTES, BYTES_PER_MS = 44, 32

# Forms of segment names.
SEGMENT_URI = r"^s3://[^/]+/.+\.wav$"
# the first of the base name, which it begins
SEGMENT_NAME = r"^(?:.*/)?(\d{3})-(\d{6})-(\d+)-v\d\.wav[^/]*$"
SEGMENT_PAIR = r"/(\d+)-(\d+)[^/]*-v2\.wav$"
