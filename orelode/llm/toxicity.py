"""Abusive, threatening, hateful and sexually explicit passages, tagged by a linear-chain CRF.

Each sentence is a chain of tokens with labels clean and toxic.  Tokens are read through common
disguises (look-alike letters, digits for letters, signs in place of letters, letters spaced out or
repeated, invisible characters, small typos).  Features are the read word, its neighbours, word
pairs, the word's lexicon classes and the classes met in the sentence, hashed into one table.
The CRF is trained on labelled tokens: example sentences, among them such of which only a marked
part offends, and the hand-judged documents, whose tokens get labels from the model of the first
round where the judgement agrees.
Forward-backward marginals give each token's probability; runs of toxic tokens are the offending
spans, and a document's score is the greatest mean marginal of a run.

Defined results: null and blank texts score 0 and have no spans; equal texts score equally; texts
of any length are read whole, long sentences in chains of at most ``CHAIN`` tokens.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from orelode.llm.strings import ascii_fold, damerau, deletions
from orelode.plans.runtime import spread

BITS, CHAIN = 18, 64
#: At most so many hand-judged documents are used for training (those with the least hash).
SAMPLE = 4000
THRESHOLD = 0.5

# Words by class.
INSULT = (
    "idiot idiots moron morons imbecile imbeciles cretin cretins dumbass dumbasses dickhead dickheads asshole assholes arsehole arseholes shithead shitheads scumbag scumbags bastard bastards bitch bitches prick pricks "
    "wanker wankers twat twats retard retards cunt cunts motherfucker motherfuckers pig pigs swine jackass douchebag douchebags fuckface dipshit halfwit lowlife pissflap "
    "puta puto putas mierda cabron cabrones pendejo gilipollas imbecil idiota maricon zorra merda filho otario caralho vadia arrombado connard connasse salope pute foutre salaud encule batard abruti "
    "arschloch hurensohn fotze schlampe wichser missgeburt drecksau verpiss fresse spast anjing bangsat bajingan goblok tolol keparat brengsek bodoh babi"
).split()
PROFANE = "fuck fucking fucked fucker fuckers shit shitty bullshit goddamn piss crap puta mierda joder coño carajo merda porra foda foder caralho merde putain chier scheisse scheiss verdammte fick ficken kontol memek jancok".split()
SEXUAL = "cock dick tits boobs pussy blowjob blowjobs nude nudes naked porn porno horny sex sexy slut sluts whore whores cum anal penis vagina masturbate follar follarte cogerte verga polla tetas desnuda chupame foder boceta buceta gostosa baiser nichons ficken titten geil lonte ngentot bugil memek".split()
HATE = "vermin subhuman subhumans disease rats cockroaches parasites animals thieves breed breeding crawled scum plague filth infest savages ratas plaga escoria cucarachas ratos praga vermine parasites cafards ungeziefer pack parasiten hama sampah tikus".split()
GROUP = (
    "women woman gays gay lesbians jews muslims christians blacks whites immigrants immigrant migrants migrant foreigners foreigner refugees cripples tribes gypsies natives "
    "forasteros extranjeros inmigrantes mujeres migrantes estrangeiros imigrantes mulheres etrangers femmes immigres auslander frauen fluchtlinge pendatang perempuan asing"
).split()
EXPEL = "driven wipe send back trust rifles echarlos echar fuera palos jagt raus vertreiben dehors chassez fora expulsar usir leave map".split()
VIOLENT = "kill break burn shoot stab hang choke chokes beat bury bullet legs neck throat skull grave box jump miss knife rompo romper matar mato cara quebro quebrar tuer crever casser umbringen toten schlag bunuh mati hajar bakar".split()
YOU = "you your yours youre yourself u te ti tu tus usted voce seu sua du dich dir dein toi ta ton vous kau kamu mulutmu lo".split()
NEUTRAL = "condemns condemn rejects forbids condena rechaza condamne verurteilt mengecam complaint investigated hotline policy insultos hatred odio haineux training workshop harassment abuse".split()
CLASSES = (INSULT, PROFANE, SEXUAL, HATE, GROUP, EXPEL, VIOLENT, YOU, NEUTRAL)
I_, P_, S_, H_, G_, E_, V_, Y_, N_, TYPO_ = (1 << i for i in range(10))
_MASK: dict[str, int] = {}
for _i, _words in enumerate(CLASSES):
    for _w in _words:
        _MASK[ascii_fold(_w)] = _MASK.get(ascii_fold(_w), 0) | 1 << _i
_STRONG = list(dict.fromkeys(ascii_fold(w) for w in (*INSULT, *PROFANE, *SEXUAL) if len(w) >= 4))
_BY_FIRST: dict[str, list[str]] = {}
for _w in _STRONG:
    _BY_FIRST.setdefault(_w[0], []).append(_w)
#: Ordinary words a letter away from a listed one.
ORDINARY = set(
    "slope where whole osario glossary cuts cute perra sale sales shell cool code cross putt tried trial suite luck duck suck sock rock lock clock cook dock dirk deck pick price brick trick pitch batch botch birch witch ditch fitch bench beach ships shift shirt short shut shot sheet site spit suit set sent six text tests tips tons tits pump part port pork pond post poor mode made merge media mill mills miss medal metal meta nude nodes note node name named nature base bass basin best boots books booms bombs cups cut cock cocks crop craft cramp clap coal pole poll pile pine point punt hint hunt count court mount runt cent pussy pushy busy bitte porno ports fort forte feld fire folder fodder holder order filler filter fuel full fault flick pasta pista pauta punta justa pure pute puts put putty pity pita puma para pata porta borda corda verge verba vega veiga bolla holla villa ladder madder ratio ration retro return record regard guard anal annual canal final animal panal sexto sector serie suits slit slot slut shunt slag ".split()
)
LOOKALIKE = str.maketrans("асеіјоратухкнвмгѕԁһ" + "АСЕІЈОРТУХКНВМ" + "οαειυρτκν" + "ⅼ", "aceijopatyxkhbmrsdh" + "ACEIJOPTYXKHBM" + "oaeiuptkv" + "l")
INVISIBLE = re.compile("[\u200b\u200c\u200d\u2060\ufeff\u00ad]")
LEET = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "!": "i", "@": "a", "$": "s", "|": "l", "+": "t", "€": "e"})
TOKEN = re.compile(r"(?<![^\W_])(?:[^\W_][ .\-*_]{1,2}){3,}[^\W_](?![^\W_])|[^\W_](?:[^\W_]|[!@#$*'’+|.\-](?=[^\W_]))*|[!@$](?=[^\W_])[^\s]*[^\W_]|([.!?;\n]+)")


def _typo_index(words: list[str]) -> dict[str, list[int]]:
    index: dict[str, list[int]] = {}
    for i, w in enumerate(words):
        for rest in deletions(w, 1):
            index.setdefault(rest, []).append(i)
    return index


_TYPOS = _typo_index(_STRONG)
_LONGEST = max(map(len, _STRONG))


def _class_of(word: str) -> tuple[str, int]:
    """The word read through typos, and its classes."""
    if word in _MASK:
        return word, _MASK[word]
    if len(word) < 4 or len(word) > _LONGEST + 1 or word in ORDINARY:
        return word, 0
    # words an edit apart share what is left of them by one letter at most
    near = sorted({i for rest in deletions(word, 1) for i in _TYPOS.get(rest, ())})
    near = [w for w in map(_STRONG.__getitem__, near) if (len(w) > 4 or sorted(w) == sorted(word)) and damerau(word, w, 1) <= 1]
    for w in [w for w in near if w[0] == word[0]] or near:
        if w[0] != word[0] and (len(word) < 6 or (word[:2] != w[1::-1] and word != w[1:])):
            continue  # another first letter is mostly another word
        return w + "~", _MASK[w] | TYPO_
    return word, 0


#: Tokens read so far; emptied when full.
_READ: dict[str, tuple[str, int]] = {}


def _read(raw: str) -> tuple[str, int]:
    if len(_READ) >= 400_000:
        _READ.clear()
    got = _READ[raw] = read_token(raw)
    return got


def read_token(raw: str) -> tuple[str, int]:
    """(word, classes) of a token as typed; numbers read as 0."""
    t = ascii_fold(raw.translate(LOOKALIKE)).lower().replace("’", "'")
    if t.isdigit() or re.fullmatch(r"[\d.,:%/\-]+", t):
        return "0", 0
    spaced = re.fullmatch(r"(?:[^\W_][ .\-*_]{1,2}){2,}[^\W_]", t)
    plain = re.sub(r"[ .\-_]", "", t) if spaced else t.replace("'", "")
    if plain.isalpha():
        found, mask = _class_of(plain)
        if mask:
            return found, mask
        short = re.sub(r"(.)\1{2,}", r"\1", plain)
        for form in dict.fromkeys((short, re.sub(r"(.)\1+", r"\1", plain))):
            if form != plain and form in _MASK:
                return form, _MASK[form]
        if short != plain:
            got = _class_of(short)
            if got[1]:
                return got
        return plain, 0
    for sub in (plain.translate(LEET), plain.replace("1", "l").translate(LEET), re.sub(r"[.\-_*#]", "", plain).translate(LEET)):
        if sub.isalpha():
            found, mask = _class_of(re.sub(r"(.)\1{2,}", r"\1", sub))
            if mask and len(found) >= 3:
                return found, mask & ~TYPO_
    wild = plain.translate(LEET)
    if re.search(r"[*#]", wild) and len(re.sub(r"[^a-z]", "", wild)) >= 2:
        pattern = re.compile(re.sub(r"[*#]+", "[a-z]{0,2}", re.sub(r"[^a-z*#]", "", wild)))
        for w in _BY_FIRST.get(wild[0], ()):
            if pattern.fullmatch(w):
                return w, _MASK[w]
    parts = [p for p in re.split(r"[^a-z]+", t) if p]
    return (max(parts, key=len) if parts else "0"), 0


def chains(text: str) -> list[list[tuple[str, int, int, int]]]:
    """Sentences of (word, classes, start, end) tokens; positions count in the stored text."""
    where = None
    if INVISIBLE.search(text):
        where = [i for i, c in enumerate(text) if not INVISIBLE.match(c)]
        text = "".join(text[i] for i in where)
    out: list[list[tuple[str, int, int, int]]] = [[]]
    chain = out[0]
    for m in TOKEN.finditer(text):
        raw = m[0]
        if m.lastindex:  # the end of a sentence
            if chain and ";" not in raw:
                chain = []
                out.append(chain)
            continue
        word, mask = _READ.get(raw) or _read(raw)
        s, e = m.span()
        if mask & TYPO_ and raw[:1].isupper() and raw[1:].islower():
            # a capitalised word is a name rather than a misspelt insult, unless it opens a sentence
            # and no other capitalised word follows
            nxt = text[e : e + 2]
            if chain or nxt[1:].isupper():
                word, mask = raw.lower(), 0
        if where:
            s, e = where[s], where[e - 1] + 1
        chain.append((word, mask, s, e))
        if len(chain) >= CHAIN:
            chain = []
            out.append(chain)
    return [c for c in out if c]


def _mixed(a: np.ndarray, b: np.ndarray | int, salt: int) -> np.ndarray:
    h = (a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (np.asarray(b).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(salt * 0x1000193))
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(64 - BITS)).astype(np.int64)


@lru_cache(maxsize=400_000)
def _word_id(word: str) -> int:
    h = 1469598103934665603
    for c in word.encode():
        h = ((h ^ c) * 1099511628211) & 0xFFFFFFFFFFFFFFFF
    return h >> 16


def features(sentences: list[list[tuple]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature ids per token, sentence of each token, place in the sentence)."""
    lengths = np.array([len(s) for s in sentences])
    start = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    word = np.array([_word_id(t[0]) for s in sentences for t in s], np.uint64)
    mask = np.array([t[1] for s in sentences for t in s], np.int64)
    sent = np.repeat(np.arange(len(sentences)), lengths)
    place = np.arange(len(word)) - start[sent]
    last = place == lengths[sent] - 1
    prev = np.where(place == 0, np.uint64(1), np.roll(word, 1))
    nxt = np.where(last, np.uint64(2), np.roll(word, -1))
    has = lambda bit: (np.bitwise_or.reduceat(mask, start) & bit > 0).astype(np.int64)
    flags = (
        has(I_) | has(H_) * has(G_) << 1 | has(Y_) * has(V_) << 2 | has(S_) * has(Y_) << 3 | has(G_) * has(E_) << 4 | has(P_) << 5 | has(N_) << 6 | has(S_) << 7 | has(G_) * has(V_) << 8 | has(I_) * has(Y_) << 9
    )[sent]
    # how far the nearest word of an offending class of the sentence is, in steps of growing width
    index = np.arange(len(word))
    hit = mask & (I_ | P_ | S_ | H_ | V_ | E_) > 0
    before = np.maximum.accumulate(np.where(hit, index, -999))
    after = np.minimum.accumulate(np.where(hit, index, len(word) + 999)[::-1])[::-1]
    before = np.where(before >= start[sent], index - before, 99)
    after = np.where(after < (start + lengths)[sent], after - index, 99)
    far = np.searchsorted([1, 2, 3, 5, 8], np.minimum(before, after), side="right")
    ids = np.stack(
        [
            _mixed(word, 0, 1), _mixed(prev, 0, 2), _mixed(nxt, 0, 3), _mixed(prev, word, 4), _mixed(word, nxt, 5), _mixed(prev, nxt, 6),
            _mixed(mask, 0, 7), _mixed(flags, 0, 8), _mixed(flags, mask, 9), _mixed(flags * 8 + far, np.uint64(3), 10),
        ], axis=1,
    )
    return ids, sent, place


class Model:
    """Weights of the two-label chain: one hashed table for "toxic", and the transitions."""

    def __init__(self) -> None:
        self.table = np.zeros(1 << BITS, np.float32)
        self.trans = np.array([[1.0, -1.0], [-1.0, 1.0]])
        self.bias = -1.0

    def _grid(self, ids, sent, place):
        n, t = int(sent[-1]) + 1, int(place.max()) + 1
        em = np.zeros((n, t))
        em[sent, place] = self.table[ids].sum(1) + self.bias
        on = np.zeros((n, t), bool)
        on[sent, place] = True
        return em, on

    def _forward_backward(self, em, on):
        n, t = em.shape
        a, b = np.zeros((n, t, 2)), np.zeros((n, t, 2))
        score = np.stack([np.zeros_like(em), em], 2)
        a[:, 0] = score[:, 0]
        for i in range(1, t):
            nxt = np.logaddexp(a[:, i - 1, :1] + self.trans[0], a[:, i - 1, 1:] + self.trans[1]) + score[:, i]
            a[:, i] = np.where(on[:, i, None], nxt, a[:, i - 1])
        for i in range(t - 2, -1, -1):
            after = b[:, i + 1] + score[:, i + 1]
            prv = np.logaddexp(self.trans[:, 0] + after[:, :1], self.trans[:, 1] + after[:, 1:])
            b[:, i] = np.where(on[:, i + 1, None], prv, 0)
        z = np.logaddexp(a[:, -1, 0], a[:, -1, 1])
        return a, b, score, z

    def marginals(self, sentences: list[list[tuple]], block: int = 2048) -> list[np.ndarray]:
        """P(toxic) of every token."""
        order = sorted(range(len(sentences)), key=lambda i: len(sentences[i]))
        out: list = [None] * len(sentences)
        for s in range(0, len(order), block):
            part = order[s : s + block]
            ids, sent, place = features([sentences[i] for i in part])
            em, on = self._grid(ids, sent, place)
            a, b, _, z = self._forward_backward(em, on)
            p = np.exp(a[:, :, 1] + b[:, :, 1] - z[:, None])
            for row, i in enumerate(part):
                out[i] = p[row, : len(sentences[i])]
        return out

    def fit(self, sentences: list[list[tuple]], labels: list[list[int]], weights: list[float], rounds: int = 60, rate: float = 0.25, l2: float = 2e-4) -> None:
        """Maximum likelihood by Adagrad on chains whose tokens are labelled clean (0) or toxic (1)."""
        order = sorted(range(len(sentences)), key=lambda i: len(sentences[i]))
        blocks = []
        for s in range(0, len(order), 2048):
            part = order[s : s + 2048]
            got = features([sentences[i] for i in part])
            gold = np.zeros((len(part), int(got[2].max()) + 1))
            gold[got[1], got[2]] = np.concatenate([labels[i] for i in part])
            blocks.append((got, gold, np.array([weights[i] for i in part])))
        seen, seen_t, seen_b = np.full(1 << BITS, 1e-6), np.full((2, 2), 1e-6), 1e-6
        total = sum(weights)
        for _ in range(rounds):
            grad, grad_t, grad_b = np.zeros(1 << BITS), np.zeros((2, 2)), 0.0
            for (ids, sent, place), y, w in blocks:
                em, on = self._grid(ids, sent, place)
                a, b, score, z = self._forward_backward(em, on)
                p = np.exp(a[:, :, 1] + b[:, :, 1] - z[:, None])
                diff = ((y - p) * w[:, None])[sent, place]
                grad += np.bincount(ids.ravel(), np.repeat(diff, ids.shape[1]), 1 << BITS)
                grad_b += diff.sum()
                if em.shape[1] > 1:
                    pair = a[:, :-1, :, None] + self.trans + (b + score)[:, 1:, None, :] - z[:, None, None, None]
                    steps = on[:, 1:] * w[:, None]
                    expected = (np.exp(pair) * steps[:, :, None, None]).sum((0, 1))
                    one, two = y[:, :-1], y[:, 1:]
                    grad_t += np.array([[((1 - one) * (1 - two) * steps).sum(), ((1 - one) * two * steps).sum()], [(one * (1 - two) * steps).sum(), (one * two * steps).sum()]]) - expected
            grad = grad / total - l2 * self.table
            grad_t, grad_b = grad_t / total - l2 * self.trans, grad_b / total
            seen += grad**2
            seen_t += grad_t**2
            seen_b += grad_b**2
            self.table += (rate * grad / np.sqrt(seen)).astype(np.float32)
            self.trans += rate * grad_t / np.sqrt(seen_t)
            self.bias += rate * grad_b / np.sqrt(seen_b)


def sentence_score(p: np.ndarray) -> float:
    """Greatest mean marginal of a run of tokens that are rather toxic than not, or the greatest
    marginal if there is none."""
    hot = p > 0.5
    if not hot.any():
        return float(p.max()) if len(p) else 0.0
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hot.astype(int), [0]])))
    return max(float(p[s:e].mean()) for s, e in zip(edges[::2], edges[1::2]))


def misspelt(text: str) -> str:
    """The text with its listed words of five letters or more misspelt, one letter swapped."""

    def swap(m: re.Match) -> str:
        w = m[0]
        if not read_token(w)[1] & (I_ | P_ | S_) or len(w) < 5:
            return w
        at = 1 + len(w) % (len(w) - 2)
        return w[:at] + w[at + 1] + w[at] + w[at + 2 :] if at + 1 < len(w) else w[:-2] + w[-1] + w[-2]

    return re.sub(r"[^\W\d_]+", swap, text)


def labelled(text: str) -> list[tuple[list[tuple], list[int]]]:
    """Chains of a text and their tokens' labels: 1 within double brackets."""
    at = [(m.start(), m.end()) for m in re.finditer(r"\[\[.*?\]\]", text)]
    plain = text.replace("[[", "  ").replace("]]", "  ")
    return [(c, [int(any(s <= t[2] and t[3] <= e for s, e in at)) for t in c]) for c in chains(plain)]


def examples(seed: tuple[list[str], list[str]], marked: list[str]) -> list[tuple[list[tuple], list[int]]]:
    """Chains with token labels: passages that offend as a whole, also misspelt, sentences that do
    not, sentences with marked parts, and passages with a clean clause before or after them."""
    toxic, clean = seed
    typos = [m for t in toxic if (m := misspelt(t)) != t]
    out = [got for t in (*toxic, *typos) for got in labelled(f"[[{t}]]")]
    out += [got for t in (*clean, *marked) for got in labelled(t)]
    for i, t in enumerate(toxic if clean else ()):
        clause = clean[(7 * i) % len(clean)].rstrip(".!?")
        passage = t.rstrip(".!?")
        out += labelled(f"{clause}, [[{passage}]].") + labelled(f"[[{passage}]], {clean[(7 * i + 3) % len(clean)]}")
    return [got for got in out if got[0]]


def train(judged: list[tuple[str, float]], seed: tuple[list[str], list[str]], marked: list[str] = ()) -> Model:
    """A model from (text, share of annotators who called it toxic) and example sentences."""
    known = examples(seed, marked)
    sents, labels, weights = [c for c, _ in known], [y for _, y in known], [4.0] * len(known)
    first = Model()
    first.fit(sents, labels, weights)
    # a sentence's odds: what the first round says, times what the judgements of all documents with
    # it say, given that annotators miss some and that clean sentences stand in toxic documents too
    pool: dict[tuple, list] = {}
    docs = [(chains(t), y) for t, y in judged]
    flat = [c for cs, _ in docs for c in cs]
    marginals = iter(first.marginals(flat) if flat else [])
    base = min(0.5, max(0.02, sum(y for _, y in judged) / max(1, len(judged))))
    yes, no = np.log(0.9 / base), np.log(0.1 / (1 - base))
    for cs, y in docs:
        for c in cs:
            p = next(marginals)
            s = min(0.98, max(0.02, sentence_score(p)))
            odds = pool.setdefault(tuple(t[0] for t in c), [c, np.log(s / (1 - s)), p])
            odds[1] += y * yes + (1 - y) * no
    model = Model()
    for c, odds, p in pool.values():
        # in a sentence that offends, the tokens the first round tags, or all if it tags none
        hot = (p > 0.5).astype(int).tolist() if (p > 0.5).any() else [1] * len(c)
        sents.append(c)
        labels.append(hot if odds > 0 else [0] * len(c))
        weights.append(float(np.tanh(abs(odds) / 2)))
    model.fit(sents, labels, weights)
    return model


def judged_sample(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> list[tuple[str, float]]:
    """(text, mean judgement) of at most ``most`` judged documents, the ones with the least hash."""
    votes = labels.where("toxic is not null").groupBy("doc_id").agg(F.avg("toxic").alias("y"))
    votes = votes.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = docs.select("doc_id", "text").where("text is not null").join(votes, "doc_id").select("text", "y").orderBy("text").collect()
    return [(r["text"], r["y"]) for r in rows]


def score_documents(docs: DataFrame, labels: DataFrame, keep: list[str], spans: bool = True, most: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """``keep``, ``score``, ``toxic`` and, with ``spans``, the offending ``spans`` (start, end, p)
    of every document."""
    from orelode.llm.examples import CLEAN, MARKED, TOXIC

    model = train(judged_sample(docs, labels, most), (TOXIC, CLEAN), MARKED)
    kinds = dict(docs.dtypes)
    shared = docs.sparkSession.sparkContext.broadcast((model.table, model.trans, model.bias))  # 2**BITS weights
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in keep) + ", score double, toxic boolean" + (", spans array<struct<start:int,end:int,p:double>>" if spans else "")
    span_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model()
        m.table, m.trans, m.bias = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 128):
                b = whole.slice(at, 128)
                found = [chains(t) if t else [] for t in b.column("text").to_pylist()]
                flat = [c for cs in found for c in cs]
                ps = iter(m.marginals(flat) if flat else [])
                scores, hits = [], []
                for cs in found:
                    best, own = 0.0, []
                    for c in cs:
                        p = next(ps)
                        best = max(best, sentence_score(p))
                        if spans:
                            hot = np.flatnonzero(np.diff(np.concatenate([[0], (p > threshold).astype(int), [0]])))
                            own += [{"start": c[s][2], "end": c[e - 1][3], "p": float(p[s:e].mean())} for s, e in zip(hot[::2], hot[1::2])]
                    scores.append(best)
                    hits.append(own)
                cols = [*(b.column(c) for c in keep), pa.array(scores, pa.float64()), pa.array([s > threshold for s in scores])]
                names = [*keep, "score", "toxic"]
                if spans:
                    cols.append(pa.array(hits, span_type))
                    names.append("spans")
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return spread(docs.select(*dict.fromkeys([*keep, "text"]))).mapInArrow(run, schema)
