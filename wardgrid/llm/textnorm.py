"""Texts brought to a plain form: what an eye or a search engine takes for the same is the same."""

from __future__ import annotations

import html
import re
import unicodedata

# Letters of other scripts that look like Latin ones.
LOOKALIKES = str.maketrans(
    "аеорсхуіјѕԁһкмнтвгпѵԛԝАВЕКМНОРСТХУІЈЅԌαβεικνορτυχωΑΒΕΖΗΙΚΜΝΟΡΤΥΧɑɡıłøđʟɪ",
    "aeopcxyijsdhkmhtbrnvqwABEKMHOPCTXYIJSGabeiknoptuxwABEZHIKMNOPTYXagilodli",
)
# Characters that are not seen, among them the soft hyphen.
INVISIBLE = re.compile("[­͏؜ᅟᅠ឴឵᠋-᠎​-‏‪-‮⁠-⁤⁪-⁯ㅤ︀-️﻿ﾠ]")
# A tag is a name, alone or with attributes of which the first stands alone or has a value of any length: so
# "<5 and then >3" is none. Both patterns read each sign a bounded number of times.
_ATTRIBUTES = r"(?:\s*/?|\s+[\w:@.-]+\s*(?:=[^<>]*)?)>"
INLINE_TAG = re.compile(rf"</?(?:b|i|u|em|strong|span|a|mark|sup|sub|font|small|code|s|del|ins)\b{_ATTRIBUTES}|\[/?(?:b|i|u|url|color|size)(?:=[^\]\[]*)?\]", re.I)
TAG = re.compile(rf"</?[a-zA-Z][\w:.-]*{_ATTRIBUTES}")
BROKEN = re.compile(r"(?<=[^\W\d_])[-‐-–][ \t ]*[\r\n]+\s*(?=[^\W\d_])")
WORD = re.compile(r"[a-z0-9]+")
NUMBER = re.compile(r"(?<=\d)[.,:/](?=\d)")


def _latin_table() -> bytes:
    table = bytearray(b" " * 256)
    for code in range(256):
        base = unicodedata.normalize("NFKD", chr(code)).lower()[:1]
        if base.isascii() and base.isalnum():
            table[code] = ord(base)
        elif code < 128:
            table[code] = code
    table[0xD8] = table[0xF8] = ord("o")
    table[0xD0] = table[0xF0] = ord("d")
    return bytes(table)


_LATIN = _latin_table()
_MARK = re.compile("[\u0300-\u036f]+")
_LONG = ("ß", "æ", "Æ", "¼", "½", "¾")
_SEPARATORS = bytes(b for b in range(256) if not (48 <= b <= 57 or 97 <= b <= 122))


def without_comments(text: str) -> str:
    """The text without <!-- ... --> of any length; one that doesn't end is text."""
    out, at = [], 0
    while (begin := text.find("<!--", at)) >= 0 and (end := text.find("-->", begin + 4)) >= 0:
        out += (text[at:begin], " ")
        at = end + 3
    return "".join(out) + text[at:] if out else text


def plain(text: str) -> str:
    """Lower-case ASCII letters, digits and separators: no accents, markup, invisible or look-alike
    characters, or words broken at a line's end. What has no such form separates words."""
    if "<" in text or "[" in text:
        text = TAG.sub(" ", INLINE_TAG.sub("", without_comments(text)))
    if "&" in text:
        text = html.unescape(text)
    try:
        latin = None if "\xad" in text or any(x in text for x in _LONG) else text.encode("latin-1")
    except UnicodeEncodeError:
        latin = None
    if latin is not None:
        if b"-" in latin and (b"\n" in latin or b"\r" in latin):
            latin = BROKEN.sub("", text).encode("latin-1")
        return latin.translate(_LATIN).decode("ascii")
    text = BROKEN.sub("", INVISIBLE.sub("", text))
    text = _MARK.sub("", unicodedata.normalize("NFKD", text)).translate(LOOKALIKES).lower()
    # Lower case may bring marks anew.
    text = _MARK.sub("", text.replace("ß", "ss").replace("æ", "ae").replace("œ", "oe"))
    return text.encode("ascii", "replace").decode().replace("?", " ")


def words(text: str) -> list[str]:
    """The words of the plain text."""
    return WORD.findall(plain(text))


def doc_words(flat: str) -> list[str]:
    """The words of a plain text, with a number such as 8.7 or 14:05 as one."""
    return WORD.findall(NUMBER.sub("", flat))


def spaced_words(flat: str) -> list[str]:
    """The words of a plain text as blanks part them, without the marks inside them."""
    return [w for w in (NOT_WORD.sub("", w) for w in flat.split()) if w]


NOT_WORD = re.compile(r"[^a-z0-9]+")


def letters(flat: str) -> bytes:
    """The letters and digits of a plain text, without anything between them."""
    return flat.encode("ascii").translate(None, _SEPARATORS)
