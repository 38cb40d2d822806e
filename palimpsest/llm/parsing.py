"""Reading names and addresses as people type them: folding, vocabularies, components."""

from __future__ import annotations

import html
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

# Common vocabulary of postal addresses in English.
SUFFIXES = {
    "street": "st", "st": "st", "str": "st", "avenue": "ave", "ave": "ave", "av": "ave", "road": "rd", "rd": "rd", "boulevard": "blvd", "blvd": "blvd", "bvd": "blvd",
    "lane": "ln", "ln": "ln", "drive": "dr", "dr": "dr", "drv": "dr", "parkway": "pkwy", "pkwy": "pkwy", "pky": "pkwy", "square": "sq", "sq": "sq", "terrace": "ter", "ter": "ter", "terr": "ter",
    "place": "pl", "pl": "pl", "court": "ct", "ct": "ct", "walk": "walk", "wlk": "walk", "row": "row", "alley": "aly", "aly": "aly", "way": "way", "plaza": "plz", "plz": "plz", "highway": "hwy", "hwy": "hwy",
    "circle": "cir", "cir": "cir", "crescent": "cres", "cres": "cres", "close": "close", "quay": "quay", "wharf": "wharf", "trail": "trl", "trl": "trl", "pike": "pike",
}
DIRECTIONS = {"n": "n", "north": "n", "s": "s", "south": "s", "e": "e", "east": "e", "w": "w", "west": "w", "ne": "ne", "nw": "nw", "se": "se", "sw": "sw"}
ORDINALS = {w: str(i) for i, w in enumerate("first second third fourth fifth sixth seventh eighth ninth tenth eleventh twelfth thirteenth fourteenth fifteenth sixteenth seventeenth eighteenth nineteenth twentieth".split(), 1)}
#: Countries; the regions of a corpus are learnt from it, see :func:`addresses.learnt_regions`.
REGIONS = frozenset({"us", "usa"})

_REMARK = re.compile(r"\([^)]*\)?|\b(?:near|between|btwn|corner of|cor of|opposite|across from)\b[^,;]*")
_UNIT = re.compile(
    r"#\s*\w+|\b(?:suite|ste|unit|apt|apartment|room|rm|floor|fl)\b\.?\s*#?\s*(?=\w*\d|[a-z]\b)\w+|\b(?:\d+(?:st|nd|rd|th)|ground|first|second|third|top|main|lower|upper)\s+(?:floor|fl|flr)\b\.?|\b(?:rear|basement|bsmt|penthouse|ground floor)\b"
)
_TOKEN = re.compile(r"[a-z0-9]+(?:[-'][a-z0-9]+)*")


def fold(s: str) -> str:
    """Compatibility forms, without marks, lower case, plain apostrophes and dashes."""
    s = unicodedata.normalize("NFKD", s)
    s = "".join(c for c in s if not unicodedata.combining(c)).casefold()
    return s.translate({0x2019: "'", 0x2018: "'", 0x2BC: "'", 0x2010: "-", 0x2011: "-", 0x2012: "-", 0x2013: "-", 0x2014: "-", 0xA0: " "})


def sound(word: str) -> str:
    """A word with its interchangeable spellings folded: ph/f, oo/u, ck/c/q/k, y/i, z/s, doubled letters."""
    for a, b in (("ph", "f"), ("oo", "u"), ("ou", "u"), ("ck", "k"), ("c", "k"), ("q", "k"), ("y", "i"), ("ee", "i"), ("z", "s")):
        word = word.replace(a, b)
    return re.sub(r"(.)\1+", r"\1", word)


#: From this length on a word's keys are its first and last half of it: one edit leaves one of the two as it was.
LONG = 64


def deletions(word: str) -> list[str]:
    """The word and all words with one character less: two words one edit or transposition apart share one.

    Long words have their beginning and end instead, which keeps the property with two keys; about the limit both.
    """
    if len(word) <= 1:
        return [word]
    out = {word, *(word[:i] + word[i + 1 :] for i in range(len(word)))} if len(word) <= LONG + 1 else {word}
    if len(word) >= LONG:
        out |= {word[: LONG // 2] + "\x1e", "\x1e" + word[-(LONG // 2) :]}
    return sorted(out)


def _trimmed(a: str, b: str) -> tuple[str, str]:
    """Two words without their common beginning and end."""
    n, m = 0, min(len(a), len(b))
    while n < m and a[n] == b[n]:
        n += 1
    a, b = a[n:], b[n:]
    n, m = 0, min(len(a), len(b))
    while n < m and a[-1 - n] == b[-1 - n]:
        n += 1
    return a[: len(a) - n], b[: len(b) - n]


def edits_within(a: str, b: str, most: int) -> int:
    """Damerau-Levenshtein distance with adjacent transpositions if it is at most ``most``, else ``most`` + 1.

    Only the cells at most ``most`` off the diagonal are filled, so long words take time linear in their length.
    """
    a, b = _trimmed(a, b)
    if not a or not b or abs(len(a) - len(b)) > most:
        return min(max(len(a), len(b)), most + 1)
    far = most + 1
    before: dict[int, int] = {}
    row = {j: j for j in range(min(len(b), most) + 1)}
    for i, x in enumerate(a, 1):
        new = {0: i} if i <= most else {}
        for j in range(max(1, i - most), min(len(b), i + most) + 1):
            y = b[j - 1]
            d = min(row.get(j, far) + 1, new.get(j - 1, far) + 1, row.get(j - 1, far) + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before.get(j - 2, far) + 1)
            new[j] = min(d, far)
        if min(new.values()) > most:
            return far
        before, row = row, new
    return row.get(len(b), far)


@lru_cache(maxsize=1 << 16)
def edits(a: str, b: str) -> int:
    """Damerau-Levenshtein distance with adjacent transpositions, by bands of twice the width until one holds it."""
    a, b = _trimmed(a, b)
    longest = max(len(a), len(b))
    if longest - (Counter(a) & Counter(b)).total() == longest:  # no letter in common
        return longest
    most = 4
    while (d := edits_within(a, b, most)) > most:
        most *= 2
    return d


def _ordinal(t: str) -> str | None:
    if t in ORDINALS:
        return ORDINALS[t]
    m = re.fullmatch(r"0*(\d+)(?:st|nd|rd|th)?", t)
    return m.group(1) if m else None


def house_number(t: str) -> tuple[str, str] | None:
    """(number, other reading) of a token: 12-34 is 1234 where numbers are written so, 46-48 is the door 46 of a range."""
    m = re.fullmatch(r"0*(\d+)([a-z]?)", t)
    if m:
        return m.group(1), ""
    m = re.fullmatch(r"0*(\d+)-0*(\d+)", t)
    if not m:
        return None
    a, b = m.groups()
    if len(a) == len(b) and 0 < int(b[-9:]) - int(a[-9:]) <= 4 and a[:-9] == b[:-9]:
        return a, a + b.zfill(2)
    return a + t.split("-")[1], ""


def address(text: str, regions: frozenset[str] = REGIONS) -> dict[str, str]:
    """Components of an address; "" where one is missing: number, other (reading of it), dir, street, suffix, town, zip.

    Units, floors and remarks on nearby streets are dropped. The order of the parts does not matter as long as the
    number stands before the street or in a part of its own.
    """
    s = fold(html.unescape(text))
    s = _REMARK.sub(" , ", s)
    s = re.sub(r"(?<=\w)\.(?=\w)", " ", s).replace(".", " ")
    s = _UNIT.sub(" , ", s)
    s = re.sub(r"\s-+\s", " , ", s)
    out = dict.fromkeys(("number", "other", "dir", "street", "suffix", "town", "zip"), "")
    parts: list[list[str]] = []
    for raw in re.split(r"[,;:/|\n]+", s):
        t, found = [], _TOKEN.findall(raw)
        for i, x in enumerate(found):
            # five digits are a zip code, but not where a street follows them
            if re.fullmatch(r"\d{5}", x) and not (i == 0 and any(y in SUFFIXES for y in found[2:])):
                out["zip"] = x
            elif x not in regions:
                t.append(x)
        if t:
            parts.append(t)
    # the part that is a lone number, else the first part that starts with one and goes on
    lone = next((p for p in parts if len(p) == 1 and house_number(p[0])), None)
    body = None
    if lone is not None and any(_street_like(p) for p in parts if p is not lone):
        out["number"], out["other"] = house_number(lone[0])
        parts.remove(lone)
        body = next((p for p in parts if _street_like(p)), None)
        if body is not None:
            parts.remove(body)
    else:
        body = next((p for p in parts if len(p) > 1 and house_number(p[0]) and p[1] not in SUFFIXES), None)
        if body is not None:
            parts.remove(body)
            out["number"], out["other"] = house_number(body[0])
            body = body[1:]
        elif lone is not None and len(parts) > 1:
            out["number"], out["other"] = house_number(lone[0])
            parts.remove(lone)
            body = parts.pop(0)
        else:
            body = next((p for p in parts if _street_like(p)), None)
            if body is not None:
                parts.remove(body)
    rest = _read_street(body, out, bool(parts)) if body else []
    words = [w for p in ([rest] if rest else []) + parts for w in p if not w.isdigit()]
    out["town"] = " ".join(words)
    return out


def _street_like(p: list[str]) -> bool:
    return any(t in SUFFIXES for t in p[1:]) or (len(p) > 1 and p[0] in DIRECTIONS and _ordinal(p[1]) is not None)


def _read_street(p: list[str], out: dict[str, str], more: bool) -> list[str]:
    """Fill dir, street and suffix from the tokens after the number; what is left belongs to the town."""
    p = list(p)
    if len(p) > 1 and p[0] in DIRECTIONS and (p[1] not in SUFFIXES or len(p) > 2 and p[2] in SUFFIXES):
        out["dir"] = DIRECTIONS[p.pop(0)]
    at = next((i for i, t in enumerate(p) if i and t in SUFFIXES), None)
    if at is None:
        cut = len(p) if more or len(p) == 1 else len(p) - 1
        if len(p) > 1 and _ordinal(p[0]) is not None:
            cut = 1
        name, rest = p[:cut], p[cut:]
    else:
        # St before a name is a saint, not a street: the last suffix of the part's street counts
        out["suffix"] = SUFFIXES[p[at]]
        name, rest = p[:at], p[at + 1 :]
        if rest and rest[0] in DIRECTIONS and not out["dir"]:
            out["dir"] = DIRECTIONS[rest.pop(0)]
    if len(name) == 1 and (n := _ordinal(name[0])) is not None:
        out["street"] = n
    else:
        out["street"] = "".join(re.sub(r"[^a-z0-9]", "", t) for t in name)
    return rest


# Words that say what kind of house a name is, each with the ways it is written.
KINDS = {
    "restaurant": "restaurant restaurante ristorante eatery restnt rstrnt rstrt rest", "bar": "bar", "wine": "wine", "house": "house hse hs", "supper": "supper", "club": "club", "ramen": "ramen", "counter": "counter center centre", "tea": "tea",
    "parlor": "parlor parlour", "noodle": "noodle noodles", "curry": "curry", "seafood": "seafood", "coffee": "coffee", "shop": "shop shoppe", "oyster": "oyster oysters", "dumpling": "dumpling dumplings",
    "empanada": "empanada empanadas", "stand": "stand", "fish": "fish", "market": "market mkt", "diner": "diner", "bistro": "bistro bistrot", "cafe": "cafe caffe", "taqueria": "taqueria", "pizzeria": "pizzeria pizza",
    "smokehouse": "smokehouse", "kitchen": "kitchen", "grill": "grill grille", "luncheonette": "luncheonette lunch", "osteria": "osteria ost os", "tavern": "tavern taverna", "barbecue": "barbecue barbeque bbq bar-b-q bar-b-que barbq",
    "canteen": "canteen cantina", "steakhouse": "steakhouse steak", "bakery": "bakery bakehouse", "trattoria": "trattoria", "brasserie": "brasserie", "delicatessen": "delicatessen deli", "rotisserie": "rotisserie",
    "brothers": "brothers bros", "sisters": "sisters", "sons": "sons", "daughters": "daughters", "company": "company co", "pub": "pub", "inn": "inn", "creamery": "creamery", "cantina": "cantina", "chophouse": "chophouse",
    "gelateria": "gelateria", "patisserie": "patisserie", "izakaya": "izakaya", "sushi": "sushi", "room": "room", "garden": "garden", "lounge": "lounge", "hall": "hall", "bodega": "bodega", "rice": "rice", "soup": "soup", "burger": "burger burgers",
    "old": "old", "new": "new", "little": "little", "mount": "mount mt", "saint": "saint st", "maison": "maison mai ma", "casa": "casa cas ca", "chez": "chez", "la": "la", "le": "le", "il": "il", "el": "el",
}
#: Given names with their nicknames.
GIVEN = {
    "theodore": "ted teddy theo", "richard": "rick dick rich richie ricky", "alexander": "alex sasha sandy xander", "margaret": "peg peggy meg maggie margie greta", "lawrence": "larry laurence", "elizabeth": "liz beth betty eliza lizzie bess",
    "william": "bill will billy willy liam", "dolores": "lola lolita", "susannah": "sue susie susanna suzy suzie", "robert": "bob rob bobby robbie bert", "giuseppe": "beppe peppe pino peppino", "henrietta": "hattie etta hetty", "francisco": "paco pancho frank curro",
    "charles": "charlie chuck chas", "antonio": "toni nino tony", "eleanor": "nell nora ellie elly", "jose": "pepe", "katherine": "kate kathy katie kitty kat kay", "michael": "mike mick mikey", "patricia": "pat trish patty tricia",
    "edward": "ed eddie ned", "james": "jim jimmy jamie", "john": "jack johnny", "joseph": "joe joey", "thomas": "tom tommy", "samuel": "sam sammy", "benjamin": "ben benny", "daniel": "dan danny", "dorothy": "dot dotty dolly", "mary": "molly polly", "anthony": "anton",
    "victoria": "vicky tori", "rebecca": "becky", "catherine": "cathy cat", "andrew": "andy drew", "christopher": "chris kit", "nicholas": "nick nicky", "matthew": "matt", "frances": "fran fanny", "isabella": "bella izzy", "ramon": "moncho", "ignacio": "nacho", "guadalupe": "lupe",
}
_KIND = {w: k for k, ws in KINDS.items() for w in ws.split()}
_NAME = {w: k for k, ws in GIVEN.items() for w in [k, *ws.split()]}
_NOISE = frozenset("the and of n s at a i llc inc ltd corp incorporated by".split())
_VOWELS = frozenset("aeiou")


@lru_cache(maxsize=1 << 14)
def _kind(t: str, dotted: bool) -> str | None:
    """The word a token stands for: itself, a clipped form (tratt.), its skeleton (ktchn), or with one slip."""
    bare = t.replace("-", "")
    if t in _KIND or bare in _KIND:
        return _KIND.get(t) or _KIND[bare]
    if len(bare) < 2:
        return None
    skeleton = not any(c in _VOWELS for c in bare)
    best = None
    for w, k in _KIND.items():
        if len(w) > len(bare) and w[0] == bare[0]:
            clipped = dotted and w.startswith(bare)
            dropped = (skeleton or dotted) and len(bare) > 1 and _subsequence(bare, w) and (dotted or bare[-1] == w[-1] or len(bare) > 2)
            if clipped or dropped:
                rank = (not clipped, len(w))
                if best is None or rank < best[0]:
                    best = (rank, k)
    return best[1] if best else None


def _subsequence(a: str, b: str) -> bool:
    it = iter(b)
    return all(c in it for c in a)


def _slip(t: str) -> str | None:
    """A word of the vocabulary of six letters or more that is one edit away."""
    if len(t) < 5:
        return None
    for w, k in _KIND.items():
        if len(w) >= 6 and abs(len(w) - len(t)) <= 1 and edits_within(t, w, 1) == 1:
            return k
    return None


@dataclass(frozen=True)
class Vocabulary:
    """What the corpus adds to the fixed words: common words, names of towns, and the phrase that initials stand for."""

    common: frozenset[str] = frozenset()
    towns: frozenset[str] = frozenset()
    initials: dict[str, str] = field(default_factory=dict)


NOTHING = Vocabulary()


def _segments(text: str, known: Vocabulary) -> Iterator[list[tuple[str, str]]]:
    """The parts of a name between separators, each a list of (role, word); a role is kind, given or own."""
    s = fold(html.unescape(text))
    s = s.replace("&", " and ").replace("+", " and ")
    s = re.sub(r"(?<=\w)\W+(?:and|n)\W+bar\W*$", "", s)  # a bar beside the house is no other house
    s = re.sub(r"'s\b|s'(?!\w)", lambda m: "" if m.group().startswith("'") else "s", s)
    for seg in re.split(r"[,;:()\[\]]|\s[-|/]+\s", s):
        seg = re.sub(r"\b([a-z])\.\s?([a-z])\b\.?(?![a-z])", r"\1\2", seg)  # s.c. is sc
        out = []
        for m in re.finditer(r"[a-z0-9]+(?:[-'][a-z0-9]+)*(\.?)", seg):
            t, dotted = m.group().rstrip("."), bool(m.group(1))
            if t in _NOISE and not (dotted and len(t) == 1):
                continue
            if t in _KIND or t in known.common:
                out.append(("kind", _KIND.get(t, t)))
            elif t in known.initials:
                out += [("kind", k) for k in known.initials[t].split()]
            elif k := _kind(t, dotted):
                out.append(("kind", k))
            elif t in _NAME:
                out.append(("given", _NAME[t]))
            elif len(t) == 1 and t.isalpha():
                out.append(("given", t))
            else:
                out.append(("own", t))
        if out:
            yield out


def name(text: str, known: Vocabulary = NOTHING) -> dict[str, str]:
    """Parts of a name: core (its own words, as one), given (name, or an initial), kinds (sorted words of its kind).

    The order of the parts, articles, company forms and a town in brackets or after a separator do not matter.
    """
    kinds: set[str] = set()
    given, words = "", []
    for i, seg in enumerate(_segments(text, known)):
        if i and all(w in known.towns for _, w in seg):
            continue
        kinds.update(w for role, w in seg if role == "kind")
        given = given or next((w for role, w in seg if role == "given"), "")
        words = words or [w for role, w in seg if role == "own"]
    if len(words) > 1:
        slips = [w for w in words if _slip(w)]
        if slips and len(slips) < len(words):
            kinds.update(_slip(w) for w in slips)
            words = [w for w in words if w not in slips]
    kinds -= {"restaurant"}
    return {"core": "".join(re.sub(r"[^a-z0-9]", "", w) for w in words), "given": given, "kinds": " ".join(sorted(kinds))}


def name_evidence(text: str) -> tuple[list[tuple[str, str]], list[tuple[str, str]]]:
    """What a name says about the vocabulary: (own word, beginning of what stands beside it), (initials, phrase of two kinds)."""
    beside, phrases, own = [], [], []
    for seg in _segments(text, NOTHING):
        own += [w for role, w in seg if role == "own"]
        phrases += [(a[0] + b[0], f"{a} {b}") for (r, a), (q, b) in zip(seg, seg[1:]) if r == q == "kind"]
    if len(own) > 1:
        beside = [(w, sound("".join(own[:i] + own[i + 1 :]))[:3]) for i, w in enumerate(own) if len(w) > 2]
    return beside, phrases


def phone(text: str | None) -> str:
    d = re.sub(r"\D", "", text or "")
    return d[-10:] if len(d) >= 7 else ""


def website(text: str | None) -> str:
    """The distinguishing word of a website: its host's first label, or the first part of the path on a shared host."""
    m = re.match(r"\s*(?:[a-z]+://)?(?:www\.)?([^/\s?#]+)(?:/([^/\s?#]*))?", (text or "").casefold())
    if not m:
        return ""
    host, path = m.group(1), m.group(2) or ""
    label = host.split(".")[0]
    if label in ("social", "facebook", "instagram", "twitter", "x") and path:
        label = path
    return re.sub(r"[^a-z0-9]", "", fold(label))
