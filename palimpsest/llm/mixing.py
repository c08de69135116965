"""Mixing to target weights with soft membership.

A classifier, fitted on a labelled table, gives every document the posterior
probability of each domain.  Every document then gets a nonnegative rate, such that the
expected tokens of each domain (the sum over documents of rate x tokens x posterior) match the
targets.  Rates start at 1 and follow the projected gradient of the squared misfit, with
misfits in units of the domain's own tokens and rates in units of a document's; so those
rates change least whose documents matter least.  The rate of a document is a function of
its posterior and of the misfits of all steps, a few numbers, so a step is one aggregation of
a narrow table and nothing is joined.  Rates have no upper limit, and steps go on until the
targets are matched or shown to be out of reach.

Everything is DataFrame expressions but the calibration, a small regression on the driver over a
few numbers for each labelled row.  The labelled rows are broadcast, at most
``labelled_rows`` of them (those with the smallest hashes); word counts and totals cover all
documents.  Documents are written once to the shared folder with their posterior, and the
steps read only tokens and posterior of them.

Defined results: a null or empty text has 0 tokens and the posterior of a text without
evidence, and does not count for the fit; every row gets a rate, repeated or without an id; an id labelled with
several domains counts for the least of them; null domains and labels of absent documents are
ignored; a domain without tokens cannot be reached and is left out of the fit; targets that no rates
reach give a compromise between misfit and change, and a warning; an empty table gives an empty one.  Other columns are carried through; the added ones have names that start
with ``mix_``.
"""

from __future__ import annotations

import warnings

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.llm.quality_rules import UNIT, WORD
from palimpsest.session import staged

SEED = 77
TOLERANCE = 1e-7
GAP = 1e-2
PULL = 1e-6
FIRM_PULL = 0.05
MOST_STEPS = 40


def _units(text: Column, buckets: int) -> Column:
    """The distinct buckets of a text's units."""
    units = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(UNIT), F.lit(0))
    return F.array_distinct(F.transform(units, lambda u: F.pmod(F.xxhash64(u), F.lit(buckets)).cast("int")))


def _signs(held: Column, sizes: Column, domains: int, evidence: float, less: int) -> Column:
    """For each domain what holding a bucket adds to its evidence and to that of its marks.

    That is log(share in the domain / share in all labelled documents).  A bucket is a mark if its
    share is more than twice the overall one, by ``evidence`` standard deviations.  The counts are
    those without ``less`` documents that hold the bucket.
    """
    add = lambda a, b: a + b
    share = F.aggregate(held, F.lit(0.5), add) / F.aggregate(sizes, F.lit(1.0), add)
    out = []
    for i in range(domains):
        k, n = F.greatest(held[i] - less, F.lit(0.0)), F.greatest(sizes[i] - less, F.lit(0.0))
        ratio = F.log((k + 2 * share) / (n + 2) / share)
        telling = k - 2 * n * share > evidence * F.sqrt(n * share * (1 - share) + 1)
        out += [ratio, F.when(telling, ratio).otherwise(0.0)]
    return F.array(*out)


def _sums(found: Column, weights: Column, domains: int) -> Column:
    zeros = F.array(*(F.lit(0.0) for _ in range(2 * domains)))
    return F.aggregate(found, zeros, lambda s, g: F.zip_with(s, weights[g], lambda a, b: a + b))


def _features(sums: Column, found: Column, domain: int) -> list[Column]:
    """Evidence of marks, and all evidence divided by the number of buckets and by its root."""
    n = F.greatest(F.size(found), F.lit(1))
    return [sums[2 * domain + 1], sums[2 * domain] / n, sums[2 * domain] / F.sqrt(n)]


def calibrated(features: np.ndarray, domain: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Weights of the features and an offset for each domain, by logistic regression.

    Rows count by their tokens.  The offsets are not held back, so the expected tokens of each
    domain on the given rows are those that the labels tell; the weights are, by a tenth of what
    one row weighs.
    """
    n, domains, kinds = features.shape
    own = np.eye(domains)
    scale = np.maximum(np.abs(features).mean(axis=(0, 1)), 1e-9) if n else np.ones(kinds)
    x = np.zeros((n, domains, domains * kinds + domains))
    for k in range(domains):
        x[:, k, k * kinds : (k + 1) * kinds] = features[:, k] / scale
        x[:, k, domains * kinds + k] = 1
    w, y = tokens / max(tokens.sum(), 1.0), own[domain]
    held = np.full(x.shape[2], 0.1 / max(n, 1))
    held[domains * kinds :] = 0.0
    theta = np.zeros(x.shape[2])

    def loss(t):
        q = x @ t
        top = q.max(axis=1)
        return w @ (top + np.log(np.exp(q - top[:, None]).sum(axis=1)) - (q * y).sum(axis=1)) + held @ (t * t) / 2

    # Domains without tokens have a far offset at once.
    seen = w @ y > 0
    theta[domains * kinds :][~seen] = -30.0 if seen.any() else 0.0
    free = np.concatenate((np.repeat(seen, kinds), seen))
    for _ in range(200):
        q = x @ theta
        p = np.exp(q - q.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        slope = np.einsum("n,nk,nkj->j", w, p - y, x) + held * theta
        slope[~free] = 0.0
        if np.abs(slope).max(initial=0.0) < 1e-10:
            break
        mean = np.einsum("nk,nkj->nj", p, x)
        bend = np.einsum("n,nk,nki,nkj->ij", w, p, x, x, optimize=True) - np.einsum("n,ni,nj->ij", w, mean, mean, optimize=True)
        step = np.linalg.lstsq(bend + np.diag(held) + 1e-12 * np.eye(len(theta)), slope, rcond=None)[0] * free
        length, now = 1.0, loss(theta)
        while loss(theta - length * step) > now - 1e-4 * length * (slope @ step) and length > 1e-6:
            length /= 2
        theta = theta - length * step
    weights = theta[: domains * kinds].reshape(domains, kinds) / scale
    return np.concatenate((weights, theta[domains * kinds :, None]), axis=1)


def _told(rows: DataFrame, model: DataFrame, domains: list[str]) -> DataFrame:
    """Domain, tokens and features of each labelled row; a text does not speak for its own domain.

    Both halves of the model are columns used once, which the optimizer puts in their place: a
    column used twice would stay one, and copy the model into each row.
    """
    told = rows.filter("mix_tokens > 0")
    for n in ("all", "others"):
        told = told.withColumn(f"mix_{n}", model.select(n).scalar())
    told = told.select(
        "mix_domain",
        "mix_tokens",
        "mix_found",
        *(_sums(F.col("mix_found"), F.col(f"mix_{n}"), len(domains)).alias(n) for n in ("all", "others")),
    )
    chosen = []
    for i, name in enumerate(domains):
        own = F.col("mix_domain") == name
        both = [_features(F.col(n), F.col("mix_found"), i) for n in ("others", "all")]
        chosen += [F.when(own, x).otherwise(y).alias(f"e{i}_{k}") for k, (x, y) in enumerate(zip(*both, strict=True))]
    return told.select("mix_domain", "mix_tokens", *chosen)


def classifier(
    docs: DataFrame, labelled: DataFrame, domains: list[str], buckets: int, evidence: float, labelled_rows: int
) -> tuple[DataFrame, np.ndarray]:
    """One row of what each bucket adds, with and without one document; and the calibration.

    All buckets count, marks by themselves once more; how much is fitted on the labelled rows,
    each left out of the counts of its domain.
    """
    known = (
        labelled.filter(F.col("domain").isin(domains) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("domain").alias("mix_domain"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(labelled_rows)
    )
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    rows = rows.select("mix_domain", _tokens().alias("mix_tokens"), _units(F.col("text"), buckets).alias("mix_found"))
    rows = staged(rows, "labelled")
    per_domain = [F.count_if(F.col("mix_domain") == d).cast("double") for d in domains]
    counts = (
        rows.select("mix_domain", F.explode_outer("mix_found").alias("bucket"))
        .filter("bucket IS NOT NULL")
        .groupBy("bucket")
        .agg(F.array(*per_domain).alias("held"))
    )
    none = F.array(*(F.lit(0.0) for _ in domains))
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    sizes = rows.agg(F.array(*per_domain).alias("sizes"))
    dense = every.join(counts, "bucket", "left").select(
        "bucket", F.coalesce("held", none).alias("held"), sizes.scalar().alias("sizes")
    )
    signs = [_signs(F.col("held"), F.col("sizes"), len(domains), evidence, less) for less in (0, 1)]
    model = dense.select("bucket", signs[0].alias("all"), signs[1].alias("others"))
    listed = F.sort_array(F.collect_list(F.struct("bucket", "all", "others")))
    model = model.agg(listed.alias("t")).select(F.col("t")["all"].alias("all"), F.col("t")["others"].alias("others"))
    model = staged(model, "weights")
    flat = _told(rows, model, domains).toArrow()
    values = [flat.column(i).to_numpy() for i in range(2, flat.num_columns)]
    features = np.stack(values, axis=1).reshape(-1, len(domains), 3).astype(float)
    domain = np.array([domains.index(d) for d in flat.column(0).to_pylist()], int)
    return model, calibrated(features, domain, flat.column(1).to_numpy().astype(float))


def _tokens() -> Column:
    return F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long")


def with_posteriors(docs: DataFrame, model: DataFrame, calibration: np.ndarray, buckets: int) -> DataFrame:
    """The documents with ``mix_tokens`` (words) and ``mix_posterior``, in the order of domains."""
    rows, size = docs.withColumn("mix_weights", model.select("all").scalar()), range(len(calibration))

    def scores(found):
        def score(sums):
            return F.array(
                *(
                    sum(
                        (x * F.lit(float(w)) for x, w in zip(_features(sums, found, i), calibration[i], strict=False)),
                        F.lit(float(calibration[i][-1])),
                    )
                    for i in size
                )
            )

        return F.transform(F.array(_sums(found, F.col("mix_weights"), len(size))), score)[0]

    def softmax(s):
        most = F.array_max(s)
        total = F.aggregate(s, F.lit(0.0), lambda t, x: t + F.exp(x - most))
        return F.transform(s, lambda x: F.exp(x - most) / total)

    found = F.transform(F.array(_units(F.col("text"), buckets)), scores)
    rows = rows.withColumn("mix_tokens", _tokens()).withColumn("mix_posterior", F.transform(found, softmax)[0])
    return rows.drop("mix_weights")


def _rate(shift: list[float]) -> Column:
    """A document's rate: one and what the steps add, projected to be nonnegative."""
    return F.greatest(sum((F.col("mix_posterior")[i] * y for i, y in enumerate(shift)), F.lit(1.0)), F.lit(0.0))


def fit_rates(rows: DataFrame, targets: dict[str, float], anchor: str | None) -> tuple[list[float], list[float], bool]:
    """The sum of the steps, the tokens each domain then lacks, and if all match.

    The gradient of the squared misfit moves a document's rate by its posterior times one number
    for each domain.  These numbers are added up and rates are projected when they are used, so
    a step is one aggregation of tokens and posteriors.  A step is scaled by the second moments
    of the documents whose rates are not held at zero, which a step with the right numbers
    would do with at once, and halved until it helps.  A weak pull towards ``centre``, which
    follows, keeps steps finite.  Where targets turn out to be out of reach, the fit is
    done again with a firm pull towards rates of 1, which weighs misfit against change.
    """
    weights = [w / sum(targets.values()) for w in targets.values()]
    k = len(weights)
    narrow = rows.filter("mix_tokens > 0").select(F.col("mix_tokens").cast("double"), "mix_posterior")

    def totals(shift: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        rate, p, t = F.col("rate"), F.col("mix_posterior"), F.col("mix_tokens")
        moments = [F.sum(F.when(rate > 0, t * p[i] * p[j])) for i in range(k) for j in range(i, k)]
        found = narrow.withColumn("rate", _rate(shift.tolist())).agg(
            *(F.sum(rate * t * p[i]) for i in range(k)), *moments, F.sum(t * rate * rate / 2)
        )
        values = np.array([x or 0.0 for x in found.first()])
        second = np.zeros((k, k))
        second[np.triu_indices(k)] = values[k:-1]
        return values[:k], second + np.triu(second, 1).T, values[-1]

    start = totals(np.zeros(k))
    first = start[0]
    # A domain of less than a token has nothing to be scaled.
    usable = first >= 1
    total = first.sum()
    if anchor is not None and weights[list(targets).index(anchor)]:
        at = list(targets).index(anchor)
        total = first[at] / weights[at]
    target = np.array(weights) * total
    limit = TOLERANCE * max(total, 1.0)

    def fitted(pull: float, follow: bool) -> tuple[np.ndarray, np.ndarray]:
        shift, centre, settled = np.zeros(k), np.zeros(k), None
        now, second, energy = start

        def value(shift, energy):
            away = (first * (shift - centre) ** 2)[usable].sum()
            return target[usable] @ shift[usable] - energy - pull / 2 * away

        for _ in range(MOST_STEPS):
            misfit = target - now
            worst = np.abs(misfit[usable]).max(initial=0.0)
            if worst <= limit:
                break
            slope = np.where(usable, misfit - pull * first * (shift - centre), 0.0)
            if np.abs(slope).max() <= limit / 10:
                if not follow or (settled is not None and worst > settled * (1 - GAP)):
                    break
                centre, settled = shift, worst
                slope = np.where(usable, misfit, 0.0)
            bend = second + pull * np.diag(first)
            step = np.zeros(k)
            step[usable] = np.linalg.solve(bend[np.ix_(usable, usable)], slope[usable])
            before, length = value(shift, energy), 1.0
            while True:
                tried = shift + length * step
                now, second, energy = totals(tried)
                gained = value(tried, energy) - before
                if gained >= 1e-4 * length * (slope @ step) - 1e-13 * abs(before) or length < 1e-3:
                    break
                length /= 2
            shift = tried
        return shift, target - now

    shift, misfit = fitted(PULL, follow=True)
    matched = bool(np.abs(misfit).max(initial=0.0) <= limit)
    if not matched:
        shift, misfit = fitted(FIRM_PULL, follow=False)
    return shift.tolist(), misfit.tolist(), matched


def mix(
    docs: DataFrame,
    labelled: DataFrame,
    targets: dict[str, float],
    anchor: str | None = None,
    buckets: int = 1 << 16,
    evidence: float = 4.0,
    labelled_rows: int = 200_000,
) -> DataFrame:
    """``docs`` with ``mix_tokens``, ``mix_posterior``, ``mix_rate``, ``mix_misfit`` and ``mix_copies``.

    ``labelled`` has ``doc_id`` and ``domain``; ``targets`` has the weight of each domain.  The
    expected total is the tokens there are; with ``anchor`` it is the one that leaves the
    expected tokens of that domain as they are.  ``mix_misfit`` has the tokens that each domain
    still lacks; there is a warning if they exceed the tolerance.  ``mix_copies`` rounds a rate
    down or up by a hash of the id.
    """
    domains = list(targets)
    model, calibration = classifier(docs, labelled, domains, buckets, evidence, labelled_rows)
    rows = staged(with_posteriors(docs, model, calibration, buckets), "posteriors")
    shift, misfit, matched = fit_rates(rows, targets, anchor)
    if not matched:
        warnings.warn(f"targets not reached, tokens lacking: {dict(zip(domains, misfit, strict=True))}", stacklevel=2)
    chance = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 53)) / F.lit(float(1 << 53))
    rows = rows.withColumn("mix_rate", _rate(shift)).withColumn("mix_misfit", F.lit(misfit))
    return rows.withColumn(
        "mix_copies", (F.floor("mix_rate") + (chance < F.col("mix_rate") - F.floor("mix_rate")).cast("int")).cast("int")
    )


def mixed_documents(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], **options) -> DataFrame:
    """Each row of ``docs``, with its columns, as often as its rate says."""
    rows = docs.select(F.struct("*").alias("mix_row"), "doc_id", "text")
    found = mix(rows, labelled, targets, **options)
    copies = F.explode(F.array_repeat(F.lit(0), F.col("mix_copies")))
    return found.select("mix_row", copies.alias("mix_copy")).select("mix_row.*")
