"""Personal data: patterns propose, checksums confirm, nearby words adjust the score."""

from __future__ import annotations

import re
from collections import Counter
from datetime import date
from math import log2

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kinds whose spans are always reported, and kinds that this method adds.
BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("iban", "ssn", "id", "birthdate", "secret")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Possessive repeats and the look-behind match the same as plain ones, in linear time: a run of
# digits that fails from its first digit fails from the others. What stands before is looked at
# after the first character, so that the search can skip to characters a pattern may begin with.
_IP = re.compile(r"[0-9](?<![0-9].)[0-9]*+(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"[A-Z](?<![A-Za-z0-9].)[A-Z][0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_SSN = re.compile(r"[0-8](?<![0-9-].)[0-9]{2}(?<!000)(?<!666)-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
#: Published forms of identity numbers (Spain, France, machine-readable passports).
_DNI = re.compile(r"[0-9XYZ](?<![A-Za-z0-9].)[0-9]{7}-?[A-Z](?![A-Za-z0-9])")
_NIR = re.compile(r"[12](?<![A-Za-z0-9].) ?[0-9]{2} ?[0-9]{2} ?(?:[0-9]{2}|2[AB]) ?[0-9]{3} ?[0-9]{3} ?[0-9]{2}(?![A-Za-z0-9])")
_MRZ = re.compile(r"[A-Z0-9<](?<![A-Z0-9<].)[A-Z0-9<]{8}[0-9][A-Z<]{3}[0-9]{7}[MF<X][0-9]{7}[A-Z0-9<]{14}[0-9<][0-9](?![A-Z0-9<])")
_DATE = re.compile(r"[0-9](?<![0-9].)(?:[0-9]{3}-[0-9]{2}-[0-9]{2}|[0-9]?[./][0-9]{1,2}[./][0-9]{4})(?![0-9])")
#: Published forms of access keys; these need no word beside them.
_KEYS = re.compile(
    r"(?<![A-Za-z0-9_])(?:(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36}|github_pat_[A-Za-z0-9_]{60,}|xox[abprs]-[A-Za-z0-9-]{10,}"
    r"|[sr]k_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35}|eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]+)(?![A-Za-z0-9_])"
)
_PEM = re.compile(r"-----BEGIN ([A-Z ]*PRIVATE KEY)-----[A-Za-z0-9+/=\s]*+-----END \1-----")
#: A value that may be a key: a long run of the letters that keys are written in.
_RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+={0,2}")
_PASSWORD = re.compile(r"(?i)\b(?:password|passwd|pwd|passwort|contraseña|mot de passe)[\"']?\s{0,4}[:=]\s{0,4}[\"']?([^\s\"']{6,})")
#: One of these stands in every match of a published form, and of a password.
_KEY_STARTS = ("AKIA", "ASIA", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "github_pat_", "xox", "k_live_", "AIza", "eyJ")
_PASSWORD_STARTS = ("passw", "pwd", "contraseña", "mot de passe")
_TURNS = re.compile(r"(?<=[A-Za-z])[0-9]|(?<=[0-9])[A-Za-z]")

#: Score of a proposal, bonus of a confirmed checksum, and words near it that raise the score.
_SCORES = {"email": 0.8, "ip": 0.5, "card": 0.3, "phone": 0.5, "iban": 0.3, "ssn": 0.3, "id": 0.05, "birthdate": 0.3, "secret": 0.05}
CHECKSUM_BONUS, CONTEXT_BONUS, CONTEXT_CHARS, KEEP_FROM = 0.4, 0.3, 48, 0.5
#: Score of a secret in a published form, or of the value that a password is set to.
SURE_SECRET = 0.8
_CONTEXT = {
    "email": ("mail", "contact", "write to"),
    "ip": ("ip", "address", "host", "server", "login"),
    "card": ("card", "visa", "mastercard", "credit", "payment"),
    "phone": ("phone", "call", "tel", "mobile", "fax"),
    "iban": ("iban", "account", "bank", "konto", "cuenta", "compte"),
    "ssn": ("ssn", "social security", "social-security"),
    "id": ("dni", "nie", "nif", "identidad", "sécurité sociale", "securite sociale", "nir", "insee", "passport", "passeport", "pasaporte", "reisepass", "ausweis"),
    "birthdate": ("born", "birth", "dob", "geboren", "geburt", "nacid", "nacimiento", "né", "née", "naissance"),
    "secret": ("token", "tokens", "secret", "api", "key", "keys", "apikey", "password", "passwd", "passwort", "credential", "bearer", "auth", "authorization", "schlüssel", "clé", "clés", "clave", "claves"),
}
#: Context words that do not count as the beginning of another word, as ``key`` in ``keyboard``.
_WHOLE = frozenset(("dni", "nie", "nif", "nir", "né", "née", "token", "tokens", "api", "key", "keys", "bearer", "auth", "authorization", "clé", "clés", "clave", "claves"))


def _near(words: tuple[str, ...]) -> re.Pattern:
    # A word may be part of a name, as in ``access_key``.
    return re.compile(r"(?<![^\W_])(?:" + "|".join(w + r"(?![^\W\d_])" * (w in _WHOLE) for w in words) + ")", re.IGNORECASE)


_NEAR = {kind: _near(words) for kind, words in _CONTEXT.items()}
#: Bits per character, and changes between letters and digits, from which a run counts as random.
MIN_ENTROPY, MIN_TURNS = 3.0, 4


def luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[-1::-2]) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """ISO 13616: the first four characters go last, letters count from 10, remainder 1."""
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def dni_letter(number: str) -> bool:
    """The last letter of a Spanish number is the 23rd part's remainder in the official order."""
    digits = number[:-1].rstrip("-")
    value = int(str("XYZ".find(digits[0])) + digits[1:] if digits[0] in "XYZ" else digits)
    return "TRWAGMYFPDXBNJZSQVHLCKE"[value % 23] == number[-1]


def nir_key(number: str) -> bool:
    """French numbers end with 97 less the remainder; Corsica's letters count as 19 and 18."""
    plain = number.replace(" ", "").replace("2A", "19").replace("2B", "18")
    return 97 - int(plain[:-2]) % 97 == int(plain[-2:])


def _mrz_digit(field: str) -> str:
    return str(sum((0 if c == "<" else int(c, 36)) * (7, 3, 1)[k % 3] for k, c in enumerate(field)) % 10)


def mrz_digits(line: str) -> bool:
    """Second line of a passport (ICAO 9303): check digits of number, both dates and the whole."""
    fields = ((line[:9], line[9]), (line[13:19], line[19]), (line[21:27], line[27]))
    return all(_mrz_digit(f) == d for f, d in fields) and _mrz_digit(line[:10] + line[13:20] + line[21:43]) == line[43]


def _is_date(m: re.Match) -> bool:
    parts = [int(p) for p in re.split("[-./]", m[0])]
    year, month, day = parts if "-" in m[0] else parts[::-1]
    try:
        date(year, month, day)
    except ValueError:
        return False
    return True


def random_like(run: str) -> bool:
    """Whether letters and digits alternate often, and of many kinds, as in generated keys."""
    if len(_TURNS.findall(run)) < MIN_TURNS:
        return False
    counts = Counter(run).values()
    return -sum(n / len(run) * log2(n / len(run)) for n in counts) >= MIN_ENTROPY


def _secrets(text: str, lower: str):
    """``(start, end, sure)`` by start, without overlaps: published forms first, then passwords and random runs."""
    sure, weak = [], []
    if any(w in text for w in _KEY_STARTS):
        sure += [(m.start(), 0, m.end(), True) for m in _KEYS.finditer(text)]
    if "-----BEGIN" in text:
        sure += [(m.start(), 0, m.end(), True) for m in _PEM.finditer(text)]
    if any(w in lower for w in _PASSWORD_STARTS):
        weak += [(m.start(1), 1, m.end(1), True) for m in _PASSWORD.finditer(text) if re.search("[0-9]", m[1]) and re.search("[A-Za-z]", m[1])]
    if _named("secret", lower):
        weak += [(m.start(), 1, m.end(), False) for m in _RUN.finditer(text) if random_like(m[0])]
    done = 0
    for start, _, end, known in sorted(sure + weak):
        if start >= done:
            yield start, end, known
            done = end


def _named(kind: str, lower: str) -> bool:
    """Whether a text, in lower case, has a context word of the kind anywhere."""
    return any(w in lower for w in _CONTEXT[kind])


def _emails(text: str):
    """Leftmost, non-overlapping: found from each ``@`` outwards, so that texts without one cost nothing."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            yield start, domain.end()
            done = domain.end()
        else:
            done = at + 1
        at = text.find("@", done)


def _proposals(text: str):
    """``(kind, start, end, confirmed by a checksum)`` by kind, then start."""
    for start, end in _emails(text):
        yield "email", start, end, False
    for m in _IP.finditer(text):
        if all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in m[0].split(".")):
            yield "ip", m.start(), m.end(), False
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(digits := re.sub("[ -]", "", m[0])) <= 19 and luhn(digits):
            yield "card", m.start(), m.end(), True
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(map(str.isdigit, m[0])) <= 15:
                yield "phone", m.start(), m.end(), False
    for m in _IBAN.finditer(text):
        # Capitals and digits after it may belong to the next words: the longest valid reading counts.
        end = m.end()
        while end - m.start() >= 15:
            if mod97(text[m.start() : end].replace(" ", "")):
                yield "iban", m.start(), end, True
                break
            end = text.rfind(" ", m.start() + 15, end)
    # These count only near a word that names them: without one, the text is not searched.
    lower = text.lower()
    if _named("ssn", lower):
        for m in _SSN.finditer(text):
            yield "ssn", m.start(), m.end(), False
    if _named("id", lower):
        numbers = [(m.start(), m.end(), m) for pattern in (_DNI, _NIR, _MRZ) for m in pattern.finditer(text)]
        for start, end, m in sorted(numbers, key=lambda n: n[:2]):
            check = dni_letter if m.re is _DNI else nir_key if m.re is _NIR else mrz_digits
            if check(m[0]):
                yield "id", start, end, True
    if _named("birthdate", lower):
        for m in _DATE.finditer(text):
            if _is_date(m):
                yield "birthdate", m.start(), m.end(), False
    for start, end, sure in _secrets(text, lower):
        yield "secret", start, end, sure


def find_spans(text: str) -> list[tuple[str, int, int, float]]:
    """``(kind, start, end, score)`` in code points, end exclusive, by kind and start."""
    out = []
    for kind, start, end, confirmed in _proposals(text):
        score = (SURE_SECRET if kind == "secret" and confirmed else _SCORES[kind] + CHECKSUM_BONUS * (confirmed or kind == "secret"))
        around = text[max(0, start - CONTEXT_CHARS) : start] + "\n" + text[end : end + CONTEXT_CHARS]
        score = min(1.0, score + CONTEXT_BONUS * bool(_NEAR[kind].search(around)))
        if kind in BASE_KINDS or score >= KEEP_FROM:
            out.append((kind, start, end, round(score, 6)))
    return out


def mask(text: str) -> str:
    """The text with each span replaced by its kind in angle brackets; overlapping spans count as the first."""
    spans = sorted((start, -end, kind) for kind, start, end, _ in find_spans(text))
    if not spans:
        return text
    parts, done = [], 0
    for start, end, kind in spans:
        if start >= done:
            parts += [text[done:start], f"<{kind.upper()}>"]
        done = max(done, -end)
    return "".join([*parts, text[done:]])


def spans(text: Column | str) -> Column:
    """``ARRAY<STRUCT<kind, start, end, score>>`` of a text column; null has none."""

    @F.pandas_udf("array<struct<kind:string,start:bigint,end:bigint,score:double>>")
    def find(texts: pd.Series) -> pd.Series:
        names = ("kind", "start", "end", "score")
        return texts.map(lambda t: [dict(zip(names, s, strict=True)) for s in find_spans(t)] if t else [])

    return find(text)


def masked(text: Column | str) -> Column:
    """A text column with personal data replaced by ``<KIND>``; null stays null."""

    @F.pandas_udf("string")
    def hide(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: mask(t) if t else t)

    return hide(text)


def find_pii(docs: DataFrame) -> DataFrame:
    """``doc_id, spans``: personal data in every whole text, one row per input row.

    Kinds ``email, ip, card, phone`` are leftmost and non-overlapping per kind, dropped if a check
    fails (parts up to 255; 13 to 19 digits passing Luhn; 9 to 15 digits). The method adds
    ``iban`` (mod 97), ``ssn``, ``id`` (identity numbers by their check letters or digits),
    ``birthdate`` (valid dates) and ``secret`` (keys in a published form, values that a password
    is set to, random runs of 16 characters or more). Spans have a score: the kind's own, more if
    a checksum or a run's entropy confirms it, more if a context word is within 48 characters.
    Added kinds need a score of 0.5, so that identity numbers, social security numbers, dates and
    random runs count only near a word that names them.

    Null and empty texts have no spans; null and repeated ids and repeated rows are searched each
    on their own; an empty table gives no rows; other columns are ignored.
    """
    return docs.select(F.col("doc_id"), spans(F.col("text").cast("string")).alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """The documents with personal data masked; ``n_chars``, if there, follows the text."""
    out = docs.withColumn("text", masked("text"))
    return out.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else out
