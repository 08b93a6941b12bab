"""Reading typed names of organisations and persons into a class and a text to compare.

The class of an organisation is its line of business or type of school, that of a person
the given name; the text is the rest that tells one from another in its class.
"""

from __future__ import annotations

import re
import unicodedata

from rosterweave.llm.fusion import STAND_INS

# Lines of business and types of school, each with words that stand for it.
LINES = {
    "manufacturing": "manufacturing mfg manufact manufacture manufacturers",
    "construction": "construction constrn constr constructions",
    "technologies": "technologies technology tech technolgies",
    "consulting": "consulting consultants consult consultng consultancy",
    "healthcare": "healthcare hlthcare healthcr",
    "energy": "energy enrgy energie energies",
    "software": "software softw softwr sware",
    "pharmaceuticals": "pharmaceuticals pharma pharm pharmaceutical",
    "foods": "foods food fods",
    "industries": "industries inds ind industrie industry",
    "logistics": "logistics logs logistic",
    "engineering": "engineering engrg engg eng engr",
    "international": "international intl int internat",
    "services": "services svcs svc service servs",
    "partners": "partners sons partner",
}
SCHOOLS = {
    "technology": "technology institute inst tech it",
    "engineering": "engineering engg coll college ce",
    "university": "university univ u universitat universidad universite uni",
    "polytechnic": "polytechnic polytech poly polytechnik",
}
LEGAL = frozenset("inc ltd gmbh corp corporation incorporated co company llc pvt private limited ag plc kg sa srl bv group holding holdings the of and p".split())
_STAND_INS = frozenset(STAND_INS)
_BLANKS, _LETTER, _TEST = re.compile(r"\s+"), re.compile(r"[^\W\d_]"), re.compile(r"(applicant|candidate|test|user|person|sample|dummy)[ _#-]*\d*")
_TWO_WORDS = re.compile(r"([A-Za-z]+) ([A-Za-z]{2,})")
SITE = re.compile(r"[,\-–(]\s*(?:hq|headquarters|head office|main campus|campus|plant \d+|region \w+|evening|distance|distance learning|part[- ]time|online|\w+ campus|branch)\)?\s*$")
TITLES = frozenset("dr mr mrs ms mx miss prof sir herr frau".split())
SUFFIXES = frozenset("phd mba pmp md cpa msc bsc ma ba esq jr sr ii iii iv".split())
_TITLES_OR_SUFFIXES = TITLES | SUFFIXES
NICKNAMES = (
    "Alexander: Sasha Alex Xander Sandy; Agnieszka: Aga; Anthony: Tony; Beatrice: Trixie Bea; Benjamin: Benny Ben; Bernadette: Bernie; Catherine: Cathy Kate; Charlotte: Charlie Lottie; "
    "Christopher: Chris Kit; Deborah: Debbie; Dimitrios: Jimmy; Dorothy: Dot Dolly; Edward: Ted Ned; Elizabeth: Beth Betty Liz; Esperanza: Espe; Fernanda: Nanda; Francisco: Paco Pancho; "
    "Frederick: Freddie Fred; Gabriella: Gabi; Gregory: Greg; Gwendolyn: Gwen; Harold: Hal Harry; Hemalatha: Hema; Henrietta: Hettie; Ignacio: Nacho; Isabella: Bella Izzy; Ishwarya: Ishu; "
    "Jaspreet: Jas; Jonathan: Jonny Jon; Josephine: Josie Jo; Karthikeyan: Karthik; Katarzyna: Kasia; Kenneth: Ken; Lakshmi: Lucky; Lawrence: Larry; Leonardo: Leo; Margaret: Meg Peggy Maggie; "
    "Michael: Mick Mike; Mohammed: Mo; Narasimha: Simha; Natalia: Tasha; Nicholas: Klaus Nick; Olivia: Liv; Oswaldo: Waldo; Padmanabhan: Paddy; Patricia: Pat Trish; Penelope: Penny; "
    "Raghunath: Raghu; Rebecca: Becky; Robert: Bob Rob; Rosalind: Roz; Srinivasan: Srini; Stephen: Steve; Susannah: Suzie Sue; Theodore: Theo Teddy; Theresa: Tess; Timothy: Tim; "
    "Umashankar: Uma; Ursula: Ulla; Venkatesh: Venky; Victoria: Tori Vicky; Vincent: Vinnie; Wilhelmina: Mina; William: Bill Will; Winifred: Freda; Xiomara: Mara; Yevgenia: Zhenya; "
    "Yolanda: Yoli; Zachary: Zach; Zsuzsanna: Zsuzsi"
)


def folded(text: str) -> str:
    if text.isascii():
        return text
    text = unicodedata.normalize("NFKD", text.replace("ł", "l").replace("ø", "o").replace("ß", "ss"))
    return "".join(c for c in text if not unicodedata.combining(c))


def is_stand_in(text: str) -> bool:
    s = _BLANKS.sub(" ", text.lower()).strip("  .,:;_*[](){}<>\"'")
    return not _LETTER.search(s) or s in _STAND_INS or bool(_TEST.fullmatch(s))


def near(a: str, b: str, most: int) -> bool:
    """True if ``a`` and ``b`` are at most ``most`` edits apart, a swap counting as one."""
    if abs(len(a) - len(b)) > most:
        return False
    before, row = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        older, before, row = before, row, [i]
        for j, y in enumerate(b, 1):
            d = min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, older[j - 2] + 1)
            row.append(d)
        if min(row) > most:
            return False
    return row[-1] <= most


def class_of(token: str, lexicon: dict[str, str], known: dict[str, str | None]) -> str | None:
    """Class that a token stands for, as it is or with a typing error; ``known`` remembers."""
    if token not in known:
        exact = {w: k for k, words in lexicon.items() for w in words.split()}
        found = exact.get(token)
        if not found and len(token) >= 4:
            for k in lexicon:
                stem = k if k != "technology" else "technology"
                words = [w for w in lexicon[k].split() if len(w) >= 5]
                if any(near(token, w, 2 if len(w) >= 8 else 1) for w in [stem, *words]):
                    found = k
                    break
        known[token] = found
    return known[token]


def parse_organisation(name: str, lexicon: dict[str, str], known: dict) -> tuple[str, str] | None:
    """``(class, text)``; class ``""`` if the line is not typed; None for a stand-in."""
    if is_stand_in(name):
        return None
    s = re.sub(r"(?<=[a-z])(?=[A-Z][a-z]{3})", " ", folded(name)).lower().strip()
    s = SITE.sub("", s)
    s = re.sub(r"\bint'?l\b", "intl", re.sub(r"\bs\s*/\s*w\b|\bsoft ware\b", "software", re.sub(r"\bhealth care\b", "healthcare", s)))
    s = re.sub(r"\bc\.\s*e\.?(?=\W|$)", "ce", re.sub(r"g\.m\.b\.h\.?", "gmbh", s)).replace("-", "")
    tokens = re.findall(r"[^\W_]+", s)
    found, rest = "", []
    for t in tokens:
        if t in LEGAL:
            continue
        c = class_of(t, lexicon, known)
        if c:
            found = found if found and (c == "technology" or (c == "engineering" and found in ("university", "polytechnic"))) else c
        else:
            rest.append(t)
    if not rest:
        core = [t for t in tokens if t not in LEGAL]
        return (found, "".join(core[:1])) if core else None
    return found, "".join(rest)


def parse_person(name: str) -> tuple[str, str, str] | None:
    """``(given, family, nickname in brackets)``; given is one letter if only an initial is
    typed and ``""`` if nothing is; None for a stand-in."""
    s = folded(name)
    # most names are a given and a family name, which need no taking apart
    if (two := _TWO_WORDS.fullmatch(s)) and (len(two[1]) == 1 or not two[1].isupper()) and s.lower() not in _STAND_INS:
        given, family = two[1].lower(), two[2].lower()
        if not {given, family} & _TITLES_OR_SUFFIXES:
            return given, family, ""
    if is_stand_in(name):
        return None
    s = s.replace(" ", " ")
    nick = re.search(r"[\"“”(]\s*([^\W\d_]+)\s*[\"“”)]", s)
    s = re.sub(r"[\"“”(][^\"“”()]*[\"“”)]", " ", s)
    parts = [[t for t in re.split(r"[\s._]+", p) if t] for p in s.split(",")]
    parts = [[t for t in p if t.lower() not in SUFFIXES or len(p) > 2 and i == 0] for i, p in enumerate(parts)]
    parts = [p for p in parts if p]
    while len(parts) > 1 and not parts[-1]:
        parts.pop()
    tokens = parts[1] + parts[0] if len(parts) > 1 else parts[0] if parts else []
    while len(tokens) > 1 and tokens[0].lower() in TITLES:
        tokens = tokens[1:]
    while len(tokens) > 2 and tokens[-1].lower() in SUFFIXES:
        tokens = tokens[:-1]
    tokens = [re.sub(r"[^\w]", "", t) for t in tokens]
    tokens = [t for t in tokens if t]
    if not tokens:
        return None
    if len(parts) < 2 and len(tokens) > 1:
        if len(tokens[-1]) == 1:
            tokens = [tokens[-1], *tokens[:-1]]
        elif tokens[0].isupper() and len(tokens[0]) > 1 and not tokens[-1].isupper():
            tokens = [*tokens[1:], tokens[0]]
    given, family = (tokens[0], tokens[-1]) if len(tokens) > 1 else ("", tokens[0])
    return given.lower(), family.lower(), nick[1].lower() if nick else ""
