"""Fuzzy recognition of bibliography section names.

A name is compared with each term of a fixed dictionary: edit-similarity of the strings, of
their sorted tokens and of their token sets, on a 0..100 scale.  Where one string is at least
half as long again as the other, the shorter one is compared with all windows of its length in
the longer one instead, which counts less.  All of it is a row expression over a literal
dictionary, so section filters need neither a join nor a shuffle of the texts.

Lengths of common subsequences are bit-parallel: a term is a vector of one bit per character.
Partial strings of a term are masks on its vector: characters outside a mask let carries pass.
High cutoffs with short terms, the usual case, have a plan of their own with cheap tests first.
"""

from __future__ import annotations

import math
import re
from itertools import combinations

from pyspark.sql import Column
from pyspark.sql import functions as F

from palimpsest.functions.arrays import let, let_sql
from palimpsest.functions.languages import bibliography_terms

# The score a name must reach, the weights of the token variants, of windows, and
# of windows in a string more than eight times as long.
SCORE_CUTOFF = 91
TOKEN_WEIGHT = 0.95
PARTIAL_WEIGHT = 0.9
FAR_PARTIAL_WEIGHT = 0.6
FAR = 8

WORD_BITS = 60  # of a vector's words, so that sums do not overflow


def normalised(name: Column) -> Column:
    """Lower case, everything but letters, digits and "_" as spaces, trimmed."""
    ascii_only = F.regexp_replace(name, r"[\x80-\xff]", "")
    return F.trim(F.lower(F.regexp_replace(ascii_only, r"(?U)\W", " ")))


def _sql_pattern(term: str) -> str:
    """A term with one bit per character position, for the LCS below."""
    bits: dict[str, int] = {}
    for position, char in enumerate(term):
        bits[char] = bits.get(char, 0) | (1 << position)
    pairs = ", ".join(f"'{char}', {mask}L" for char, mask in bits.items())
    return f"named_struct('text', '{term}', 'size', {len(term)}, 'bits', map({pairs}))"


def _sql_dictionary(terms: tuple[str, ...]) -> str:
    """The dictionary as an array literal: each term with all subsets of its tokens."""
    entries = []
    for term in terms:
        tokens = sorted(set(term.split()))
        subsets = [
            " ".join(subset)
            for size in range(1, len(tokens) + 1)
            for subset in combinations(tokens, size)
        ]
        entries.append(
            "named_struct("
            f"'plain', {_sql_pattern(term)}, "
            f"'sorted', {_sql_pattern(' '.join(sorted(term.split())))}, "
            f"'set', {_sql_pattern(' '.join(tokens))}, "
            f"'tokens', array({', '.join(repr(token) for token in tokens)}), "
            f"'subsets', array({', '.join(_sql_pattern(subset) for subset in subsets)}))"
        )
    return f"array({', '.join(entries)})"


def _common(text: Column, pattern: Column) -> Column:
    """Length of the longest common subsequence of ``text`` and a dictionary pattern.

    Bit-parallel: the pattern is a bit vector, and each character of the text is one step of
    integer arithmetic.
    """
    full = F.call_function("shiftleft", F.lit(1).cast("bigint"), pattern["size"]) - 1

    def step(row: Column, char: Column) -> Column:
        hits = F.coalesce(F.try_element_at(pattern["bits"], char), F.lit(0).cast("bigint"))
        return (row + row.bitwiseAND(hits)).bitwiseOR(
            row.bitwiseAND(F.bitwise_not(hits))
        ).bitwiseAND(full)

    return pattern["size"] - F.bit_count(F.aggregate(F.split(text, ""), full, step))


def _similar(text: Column, pattern: Column, percent: int) -> Column:
    """Whether the rounded similarity ``2 * common / (both lengths)`` reaches ``percent``."""
    both = F.length(text) + pattern["size"]
    needed = 2 * percent - 1  # of 200, half a percent below for rounding
    # Insert/delete distance is at least the Levenshtein distance, which is far cheaper, and
    # cheaper still when it is not counted beyond a threshold (-1 then).
    threshold = F.floor(both * (200 - needed) / 200).cast("int")
    plausible = F.call_function("levenshtein", text, pattern["text"], threshold) >= 0
    return plausible & (_common(text, pattern) * 400 >= both * needed)


def plain_form(text: str) -> str:
    """What ``normalised`` does, for dictionary terms."""
    return re.sub(r"\W", " ", re.sub("[\x80-\xff]", "", text)).lower().strip()


def matches_terms(
    name: Column, terms: tuple[str, ...], score_cutoff: int = SCORE_CUTOFF
) -> Column:
    """Whether ``name`` scores at least ``score_cutoff``, 0 to 100, against one of ``terms``.

    Terms may have any length and any letters.  An empty name scores 0.
    """
    if not 0 <= score_cutoff <= 100:
        raise ValueError("score_cutoff must be in 0..100")
    if score_cutoff == 0:
        return name.isNotNull()
    terms = tuple(term for term in map(plain_form, terms) if term)
    if not terms:
        return F.when(name.isNotNull(), F.lit(False))
    simple = all(len(term) <= WORD_BITS and re.fullmatch(r"[a-z0-9_ ]+", term) for term in terms)
    if score_cutoff <= 100 * PARTIAL_WEIGHT or not simple:
        return let(normalised(name), lambda text: _any_score(text, terms, score_cutoff))
    return _high_score(name, terms, score_cutoff)


def _high_score(name: Column, terms: tuple[str, ...], score_cutoff: int) -> Column:
    """The same for cutoffs that windows cannot reach, and terms of one word of bits."""
    token_cutoff = math.ceil(score_cutoff / TOKEN_WEIGHT)
    shortest = min(map(len, terms))
    longest = max(map(len, terms))

    def test(words: Column, term: Column) -> Column:
        size, term_size = F.length(words["text"]), term["plain"]["size"]
        near = F.greatest(size, term_size) * 2 < F.least(size, term_size) * 3
        return near & (
            _similar(words["text"], term["plain"], score_cutoff)
            | (_token_scores(words, term, token_cutoff) if token_cutoff <= 100 else F.lit(False))
        )

    def scored(words: Column) -> Column:
        return F.exists(F.expr(_sql_dictionary(terms)), lambda term: test(words, term))

    def by_length(text: Column) -> Column:
        # A length ratio of 1.5 or more cannot reach the cutoff, so most names stop here.
        possible = (F.length(text) * 3 > shortest * 2) & (F.length(text) * 2 < longest * 3)
        tokens = F.sort_array(F.split(text, " +"))
        words = F.struct(
            text.alias("text"),
            F.array_join(tokens, " ").alias("sorted"),
            F.array_distinct(tokens).alias("tokens"),
            F.array_join(F.array_distinct(tokens), " ").alias("distinct"),
        )
        return text.isin(*terms) | (possible & let(words, scored))

    return let(normalised(name), by_length)


def _token_scores(words: Column, term: Column, cutoff: int) -> Column:
    """Sorted-token similarity, and similarity of the token sets around their intersection."""
    needed = 2 * cutoff - 1

    def sets(common: Column) -> Column:
        extra = F.array_join(F.array_except(words["tokens"], common["tokens"]), " ")
        missing = F.array_join(F.array_except(term["tokens"], common["tokens"]), " ")
        shared = F.length(common["text"])

        def prefix_of(rest: Column) -> Column:
            return shared * 400 >= (shared * 2 + 1 + F.length(rest)) * needed

        # The shared part and one blank lead both sides; only the rest has to be compared.
        both = F.exists(
            term["subsets"],
            lambda subset: (subset["text"] == missing)
            & (
                (shared + 1 + _common(extra, subset)) * 400
                >= (shared * 2 + 2 + F.length(extra) + subset["size"]) * needed
            ),
        )
        return (extra == "") | (missing == "") | prefix_of(extra) | prefix_of(missing) | both

    common = F.array_intersect(words["tokens"], term["tokens"])
    overlapping = let(
        F.struct(common.alias("tokens"), F.array_join(common, " ").alias("text")), sets
    )
    return _similar(words["sorted"], term["sorted"], cutoff) | F.when(
        F.arrays_overlap(words["tokens"], term["tokens"]), overlapping
    ).otherwise(_similar(words["distinct"], term["set"], cutoff))


# -- any cutoff, any term --------------------------------------------------------------


def _needed(cutoff: int, *weights: float) -> int | None:
    """The least rounded similarity that reaches ``cutoff`` when it is weighed."""
    for similarity in range(101):
        score = float(similarity)
        for weight in weights:
            score *= weight
        if score >= cutoff:
            return similarity
    return None


def _reaches(common: str, both: str, percent: int) -> str:
    """Whether 2 * common / both, rounded to whole percent, halves to even, is ``percent``."""
    return f"({common}) * 400 {'>' if percent % 2 else '>='} ({both}) * {2 * percent - 1}"


def _most_common(text: str, other: str) -> str:
    """A cheap upper bound of the common length: one insertion or deletion changes one character,
    so what is not common is at least the Levenshtein distance."""
    return f"(length({text}) + length({other}) - levenshtein({text}, {other})) div 2"


def _vector(positions: list[int], words: int) -> str:
    out = [0] * words
    for position in positions:
        out[position // WORD_BITS] |= 1 << (position % WORD_BITS)
    return f"array({', '.join(f'{word}L' for word in out)})"


def _sql_vectors(text: str, words: int) -> str:
    """A string with a bit vector for each of its characters."""
    places: dict[str, list[int]] = {}
    for position, char in enumerate(text):
        places.setdefault(char, []).append(position)
    pairs = ", ".join(f"'{char}', {_vector(at, words)}" for char, at in places.items())
    whole = _vector(list(range(len(text))), words)
    return f"named_struct('text', '{text}', 'size', {len(text)}, 'whole', {whole}, 'bits', map({pairs}))"


def _sql_term(term: str, words: int) -> str:
    tokens, begin, parts = sorted(set(term.split())), 0, []
    for token in tokens:
        gap = [begin - 1] if begin else []
        body = list(range(begin, begin + len(token)))
        parts.append(
            f"named_struct('token', '{token}', 'size', {len(token)},"
            f" 'body', {_vector(body, words)}, 'gap', {_vector(gap, words)})"
        )
        begin += len(token) + 1
    return (
        f"named_struct('plain', {_sql_vectors(term, words)},"
        f" 'sorted', {_sql_vectors(' '.join(sorted(term.split())), words)},"
        f" 'set', {_sql_vectors(' '.join(tokens), words)},"
        f" 'names', array({', '.join(repr(token) for token in tokens)}),"
        f" 'tokens', array({', '.join(parts)}))"
    )


class _Scores:
    """SQL for terms whose vectors have ``words`` words."""

    def __init__(self, words: int):
        self.words = words
        self.none = f"array({', '.join(['0L'] * words)})"

    def common(self, text: str, pattern: str, mask: str) -> str:
        """Length of the longest common subsequence of a text and a masked pattern."""
        ones = (1 << WORD_BITS) - 1
        carry, steps = "0L", []
        for i in range(self.words):
            total = f"(v[{i}] + (v[{i}] & h[{i}]) + {carry})"
            steps.append(f"(({total} | (v[{i}] & ~h[{i}])) & {ones}L)")
            carry = f"shiftright({total}, {WORD_BITS})"
        masked = ", ".join(f"m[{i}] & k[{i}]" for i in range(self.words))
        hits = f"transform(array(coalesce(try_element_at({pattern}.bits, c), {self.none})), m -> array({masked}))[0]"
        step = f"transform(array({hits}), h -> array({', '.join(steps)}))[0]"
        counted = " + ".join(f"bit_count(k[{i}] & ~v[{i}])" for i in range(self.words))
        start = f"array({', '.join([f'{ones}L'] * self.words)})"
        run = f"aggregate({_sql_chars(text)}, {start}, (v, c) -> {step}, v -> {counted})"
        return f"transform(array({mask}), k -> {run})[0]"

    def window(self, begin: str, size: str) -> str:
        """The mask of ``size`` characters from ``begin``."""

        def bit(place: str, i: int) -> str:
            return f"shiftleft(1L, least(greatest({place} - {i * WORD_BITS}, 0), {WORD_BITS}))"

        return f"array({', '.join(f'{bit(f'({begin} + {size})', i)} - {bit(begin, i)}' for i in range(self.words))})"

    def whole(self, text: str, pattern: str, percent: int | None) -> str:
        """Whether the similarity of two strings reaches ``percent``."""
        if percent is None or percent == 0:
            return "false" if percent is None else "true"
        both = f"length({text}) + {pattern}.size"
        possible = _reaches(f"least(length({text}), {pattern}.size)", both, percent)
        plausible = _reaches(_most_common(text, f"{pattern}.text"), both, percent)
        exact = _reaches(self.common(text, pattern, f"{pattern}.whole"), both, percent)
        return f"({possible} AND {plausible} AND {exact})"

    def partial(self, text: str, pattern: str, percent: int | None) -> str:
        """Whether the shorter string and some window of the longer one reach ``percent``."""
        if percent is None or percent == 0:
            return "false" if percent is None else "true"
        n, k = f"length({text})", f"{pattern}.size"
        # No window has more in common than the whole longer string.
        both = f"2 * least({n}, {k})"
        plausible = _reaches(_most_common(text, f"{pattern}.text"), both, percent)
        bound = _reaches(self.common(text, pattern, f"{pattern}.whole"), both, percent)
        part, piece = f"substring({pattern}.text, s + 1, {n})", f"substring({text}, s + 1, {k})"
        inside = (
            f"{_reaches(_most_common(text, part), both, percent)}"
            f" AND {_reaches(self.common(text, pattern, self.window('s', n)), both, percent)}"
        )
        around = (
            f"{_reaches(_most_common(piece, f'{pattern}.text'), both, percent)}"
            f" AND {_reaches(self.common(piece, pattern, f'{pattern}.whole'), both, percent)}"
        )
        return (
            f"({plausible} AND {bound} AND CASE WHEN {n} <= {k}"
            f" THEN exists(sequence(0, {k} - {n}), s -> {inside})"
            f" ELSE exists(sequence(0, {n} - {k}), s -> {around}) END)"
        )

    def sets(self, percent: int | None) -> str:
        """Whether two of shared tokens, all tokens of one and all of the other reach it."""
        if percent is None or percent == 0:
            return "false" if percent is None else "true"
        joined = {"f": "length(f)", "g": "g.size"}
        ors = ", ".join(
            f"a.mask[{i}] | x.body[{i}] | CASE WHEN a.size > 0 THEN x.gap[{i}] ELSE 0L END" for i in range(self.words)
        )
        missing = (
            "aggregate(filter(t.tokens, x -> NOT array_contains(w.tokens, x.token)),"
            f" named_struct('size', 0, 'mask', {self.none}),"
            " (a, x) -> named_struct('size', a.size + x.size + CASE WHEN a.size > 0 THEN 1 ELSE 0 END,"
            f" 'mask', array({ors})))"
        )
        one = f"(n + CASE WHEN {joined['f']} > 0 THEN 1 + {joined['f']} ELSE 0 END)"
        two = f"(n + CASE WHEN {joined['g']} > 0 THEN 1 + {joined['g']} ELSE 0 END)"
        rest = f"CASE WHEN length(f) > 0 AND g.size > 0 THEN n + 1 + {self.common('f', 't.set', 'g.mask')} ELSE n END"
        shared = (
            f"{_reaches('n', f'n + {one}', percent)} OR {_reaches('n', f'n + {two}', percent)}"
            f" OR {_reaches(rest, f'{one} + {two}', percent)}"
        )
        extra = "array_join(array_except(w.tokens, t.names), ' ')"
        n = "length(array_join(array_intersect(w.tokens, t.names), ' '))"
        bound = (
            f"transform(array({n}), n -> transform(array({extra}), f ->"
            f" transform(array({missing}), g -> {shared})[0])[0])[0]"
        )
        return f"CASE WHEN arrays_overlap(w.tokens, t.names) THEN {bound} ELSE {self.whole('w.distinct', 't.set', percent)} END"

    def partial_sets(self, percent: int | None) -> str:
        """The shared tokens are a part of each string."""
        if percent is None:
            return "false"
        return f"(arrays_overlap(w.tokens, t.names) OR {self.partial('w.distinct', 't.set', percent)})"

    def reaches(self, cutoff: int) -> str:
        near = [
            self.whole("w.sorted", "t.sorted", _needed(cutoff, TOKEN_WEIGHT)),
            self.sets(_needed(cutoff, TOKEN_WEIGHT)),
        ]
        apart = []
        for weight in (PARTIAL_WEIGHT, FAR_PARTIAL_WEIGHT):
            token = _needed(cutoff, TOKEN_WEIGHT, weight)
            apart.append(
                f"({self.partial('w.text', 't.plain', _needed(cutoff, weight))} OR {self.partial_sets(token)}"
                f" OR {self.partial('w.sorted', 't.sorted', token)})"
            )
        n, k = "length(w.text)", "t.plain.size"
        return (
            f"{self.whole('w.text', 't.plain', cutoff)} OR CASE"
            f" WHEN greatest({n}, {k}) * 2 < least({n}, {k}) * 3 THEN {near[0]} OR {near[1]}"
            f" WHEN greatest({n}, {k}) > {FAR} * least({n}, {k}) THEN {apart[1]} ELSE {apart[0]} END"
        )


def _sql_chars(text: str) -> str:
    """The characters of a string, code point by code point."""
    return f"transform(array({text}), y -> transform(filter(sequence(1, length(y)), i -> length(y) > 0), i -> substring(y, i, 1)))[0]"


def _any_score(text: Column, terms: tuple[str, ...], cutoff: int) -> Column:
    by_words: dict[int, list[str]] = {}
    for term in terms:
        by_words.setdefault(-(-len(term) // WORD_BITS), []).append(term)
    tests = [
        f"exists(array({', '.join(_sql_term(term, words) for term in some)}), t -> {_Scores(words).reaches(cutoff)})"
        for words, some in by_words.items()
    ]
    tokens = F.sort_array(F.split(text, " +"))
    words = F.struct(
        text.alias("text"),
        F.array_join(tokens, " ").alias("sorted"),
        F.array_distinct(tokens).alias("tokens"),
        F.array_join(F.array_distinct(tokens), " ").alias("distinct"),
    )
    return F.when(text == "", F.lit(False)).otherwise(let_sql(words, f"w -> {' OR '.join(tests)}"))


def is_bibliography(
    name: Column, language: str, score_cutoff: int = SCORE_CUTOFF
) -> Column:
    """Whether a section name is a bibliography heading in ``language``."""
    return matches_terms(name, bibliography_terms(language), score_cutoff)
