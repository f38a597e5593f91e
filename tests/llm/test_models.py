"""The vectorised models against plain ones: trees walked row by row, and the non-negative risk on dense rows."""

import numpy as np

from spotloom.llm import boosting, quality, toxicity


def test_boosted_trees_against_a_walk_of_each_tree():
    r = np.random.default_rng(1)
    x = r.normal(size=(600, 5))
    y = (x[:, 0] + x[:, 1] ** 2 > 0.7).astype(float)
    forest = boosting.fit(x, y, trees=12, depth=3)

    def walk(t, row):
        node, inner = 0, 2**forest.depth - 1
        while node < inner:
            node = 2 * node + 1 + int(row[forest.feature[t, node]] > forest.threshold[t, node])
        return forest.leaf[t, node - inner]

    slow = np.array([forest.base + sum(walk(t, row) for t in range(len(forest.leaf))) for row in x])
    assert np.allclose(forest.margin(x), slow) and np.mean((forest.probability(x) > 0.5) == y) > 0.95


def test_first_split_is_the_best_of_all():
    """Depth one: no cut of any feature has more gain than the one that the histograms find."""
    r = np.random.default_rng(3)
    x, y = np.round(r.normal(size=(300, 3)), 1), r.integers(0, 2, 300).astype(float)
    forest = boosting.fit(x, y, trees=1, depth=1, bins=64, l2=2.0, least=12)
    g, h = y.mean() - y, np.full(300, y.mean() * (1 - y.mean()))

    def gain(j, cut):
        left = x[:, j] <= cut
        if min(left.sum(), (~left).sum()) < 12:
            return -1
        return sum(g[s].sum() ** 2 / (h[s].sum() + 2) for s in (left, ~left)) - g.sum() ** 2 / (h.sum() + 2)

    best = max(gain(j, c) for j in range(3) for c in np.unique(np.quantile(x[:, j], np.linspace(0, 1, 65)[1:-1])))
    assert abs(gain(int(forest.feature[0, 0]), forest.threshold[0, 0]) - best) < 1e-9


def dense_nnpu(pos, unl, prior, chosen, steps, rate=0.1, l2=1e-3):
    """The same steps over whole rows of zeros and ones."""
    rows = lambda docs: np.array([[float(h in set(d.tolist())) for h in chosen] + [1.0] for d in docs])
    p, u = rows(pos), rows(unl)
    sig = lambda z: 1 / (1 + np.exp(-z))
    theta, m, v = np.zeros(len(chosen) + 1), 0.0, 0.0
    theta[-1] = np.log(prior / (1 - prior))
    for t in range(1, steps + 1):
        zp, zu = p @ theta, u @ theta
        plus, minus_p, minus_u = -prior * p.T @ sig(-zp) / len(p), prior * p.T @ sig(zp) / len(p), u.T @ sig(zu) / len(u)
        negative = np.log1p(np.exp(zu)).mean() - prior * np.log1p(np.exp(zp)).mean()
        grad = plus + minus_u - minus_p if negative >= 0 else minus_p - minus_u
        grad = grad + np.append(l2 * theta[:-1], 0)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        theta = theta - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
    return theta


def test_positive_unlabelled_steps_against_dense_rows():
    r = np.random.default_rng(5)
    word = lambda lo, hi, n: np.unique(r.integers(lo, hi, n).astype(np.uint64))
    pos = [np.unique(np.concatenate((word(0, 12, 6), word(20, 60, 9)))) for _ in range(60)]
    unl = [word(20, 60, 12) for _ in range(150)] + [np.unique(np.concatenate((word(0, 12, 6), word(20, 60, 9)))) for _ in range(15)]
    model = toxicity.fit_nnpu(pos, unl, 0.1, most=20, steps=80)
    chosen = sorted(model.index, key=model.index.get)
    theta = dense_nnpu(pos, unl, 0.1, chosen, 80)
    assert chosen and np.allclose(np.append(model.weight, model.bias), theta, atol=1e-6)


def test_statistics_against_plain_counts():
    text = "One two two. Three!\n\nOne two two. |x| 12\u00e9"
    got = dict(zip(quality.STATISTICS, quality.statistics(text.encode()), strict=True))
    words, size = text.split(), len(text.encode())
    assert abs(got["words"] - np.log1p(len(words))) < 1e-12 and abs(got["bytes"] - np.log1p(size)) < 1e-12
    assert abs(got["distinct_words"] - len(set(words)) / len(words)) < 1e-12 and abs(got["digit"] - 2 / size) < 1e-12
    assert abs(got["adjacent_repeats"] - sum(a == b for a, b in zip(words, words[1:], strict=False)) / len(words)) < 1e-12
    assert abs(got["commonest_word"] - max(words.count(w) for w in words) / len(words)) < 1e-12 and abs(got["bars"] - 2 / size) < 1e-12
