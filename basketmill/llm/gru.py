"""A gated recurrent language model in numpy: class-factored softmax, truncated backpropagation.

Words of the vocabulary are dealt into classes of equal size by falling frequency; one more class stands for
all other words. A word's probability is that of its class times that inside its class; what lies inside the
last class is left to the caller. Parameters are one flat vector, so that copies trained on different
parts of a corpus can be averaged.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

LOG10 = 1 / np.log(10.0)
# Ids whose scores are held at a time; a hundred scores each stay in a core's cache.
BLOCK = 1024
# Rows of a word that are added up side by side with those of other words.
FEW = 32


@dataclass(frozen=True)
class Shape:
    """``words`` vocabulary words in ``classes`` classes of ``members``, the id ``words`` standing for all others."""

    members: int
    classes: int
    hidden: int = 24

    @property
    def words(self) -> int:
        return self.members * self.classes

    def parts(self) -> dict[str, tuple[int, ...]]:
        h = self.hidden
        return {
            "input": (self.words + 1, 3 * h),
            "first": (3 * h,),
            "carry": (h, 3 * h),
            "class_out": (h, self.classes + 1),
            "class_bias": (self.classes + 1,),
            "word_out": (self.classes, h, self.members),
            "word_bias": (self.classes, self.members),
        }

    def size(self) -> int:
        return sum(int(np.prod(s)) for s in self.parts().values())

    def views(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        found, at = {}, 0
        for name, shape in self.parts().items():
            n = int(np.prod(shape))
            found[name] = flat[at : at + n].reshape(shape)
            at += n
        return found


def start(shape: Shape, counts: np.ndarray, others: float, seed: int = 5) -> np.ndarray:
    """Small random weights, and biases that give the word frequencies ``counts`` (by id) and ``others``."""
    rng = np.random.default_rng(seed)
    flat = (rng.standard_normal(shape.size()) * 0.1).astype(np.float32)
    p = shape.views(flat)
    table = (counts + 0.5).reshape(shape.classes, shape.members)
    p["first"][:] = 0
    p["class_bias"][:] = np.log(np.append(table.sum(axis=1), others + 0.5) / (table.sum() + others + 0.5))
    p["word_bias"][:] = np.log(table / table.sum(axis=1, keepdims=True))
    return flat


def _gate_weights(p: dict, h: int) -> tuple[np.ndarray, np.ndarray]:
    """What the word before (the last row: the start of a text) and the state add to the gates, as ``_step`` takes them.

    Signs and factors are those of the exponentials in a sigmoid and in a tanh.
    """
    scale = np.repeat([-1, -2], [2 * h, h]).astype(p["first"].dtype)
    table = np.empty((len(p["input"]) + 1, 3 * h), dtype=p["input"].dtype)
    np.add(p["input"], p["first"], out=table[:-1])
    table[-1] = p["first"]
    table *= scale
    return table, (p["carry"] * scale).T.copy()


def _step(gates: np.ndarray, state: np.ndarray, carry: np.ndarray, h: int, own: np.ndarray | None = None) -> tuple:
    """One step from the input's share of the gates (a row per lane); returns the new state and what learning needs.

    States have a row per feature, so that the lanes of each gate lie side by side; ``own`` is memory for the gates.
    """
    own = np.matmul(carry, state, out=own)
    both, inner = own[: 2 * h], own[2 * h :]
    both += gates[:, : 2 * h].T
    np.exp(both, out=both)
    both += 1
    np.reciprocal(both, out=both)
    keep, reset = both[:h], both[h:]
    fresh = reset * inner
    fresh += gates[:, 2 * h :].T
    # tanh, which takes twice as long by itself
    np.exp(fresh, out=fresh)
    fresh += 1
    np.divide(2, fresh, out=fresh)
    fresh -= 1
    state = state - fresh
    state *= keep
    state += fresh
    return state, keep, reset, inner, fresh


def _with_bias(weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """The bias as one more row of the weights, for states with a one at their end."""
    return np.concatenate([weights, bias[..., None, :]], axis=-2)


def _sorted_by_class(shape: Shape, states: np.ndarray, ids: np.ndarray) -> tuple:
    """The order by classes, in which each class is one slice; states with a one at their end, classes and places inside them."""
    group = np.minimum(ids // shape.members, shape.classes)
    # Two-byte numbers are sorted by counting.
    order = np.argsort(group.astype(np.int16), kind="stable")
    rows = np.ones((len(ids), shape.hidden + 1), dtype=states.dtype)
    rows[:, :-1] = states.take(order, axis=0)
    group = group[order]
    return order, rows, group, ids[order] - group * shape.members


def _inner_scores(word_out: np.ndarray, rows: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """Scores of the members, one column per row that is not of the last class, and the slice of each class."""
    first, last = int(group[0]), min(int(group[-1]) + 1, len(word_out))
    borders = np.searchsorted(group, np.arange(first, last + 1)).tolist()
    slices = [(c, low, high) for c, (low, high) in enumerate(zip(borders[:-1], borders[1:], strict=True), first) if low < high]
    x = np.empty((word_out.shape[2], borders[-1]), dtype=rows.dtype)
    for c, low, high in slices:
        np.matmul(word_out[c].T, rows[low:high].T, out=x[:, low:high])
    return x, slices


def _within_range(weights: np.ndarray, states: np.ndarray) -> bool:
    """Whether exponentials of all scores that these weights give such states stay far inside the range of numbers."""
    reach = max(1.0, float(states.max(initial=0)), -float(states.min(initial=0)))
    return bool(np.abs(weights).sum(axis=-2).max() * reach < 60)


def _log_prob(x: np.ndarray, picked: np.ndarray, plain: bool = False) -> np.ndarray:
    """Log probability of the picked row in each column of the scores ``x``, which are overwritten; ``plain``: none is large."""
    if not plain:
        x -= x.max(axis=0)
    chosen = x.reshape(-1).take(picked * x.shape[1] + np.arange(len(picked)))
    return chosen - np.log(np.exp(x, out=x).sum(axis=0))


def output_log_probs(p: dict, shape: Shape, states: np.ndarray, ids: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """Natural log probability of each id, the class alone for the last class; scores are held for ``block`` ids at a time."""
    class_out, word_out = _with_bias(p["class_out"], p["class_bias"]), _with_bias(p["word_out"], p["word_bias"])
    plain, plain_inside = _within_range(class_out, states), _within_range(word_out, states)
    order, rows, group, places = _sorted_by_class(shape, states, ids)
    sorted_found = np.empty(len(ids), dtype=states.dtype)
    for low in range(0, len(ids), block):
        some, of, found = rows[low : low + block], group[low : low + block], sorted_found[low : low + block]
        found[:] = _log_prob(class_out.T @ some.T, of, plain)
        scores = _inner_scores(word_out, some, of)[0]
        inner = scores.shape[1]
        if inner:
            found[:inner] += _log_prob(scores, places[low : low + inner], plain_inside)
    found = np.empty_like(sorted_found)
    found[order] = sorted_found
    return found


@np.errstate(over="ignore")
def score_texts(flat: np.ndarray, shape: Shape, texts: list[np.ndarray], window: int = 64, lanes: int = 512) -> np.ndarray:
    """log10 probability of each sequence of ids. The state runs through all windows of a text.

    Texts of about the same length share the steps; a text that has ended leaves the group, and the windows of few are longer.
    """
    p, h = shape.views(flat), shape.hidden
    gates_of, carry = _gate_weights(p, h)
    total = np.zeros(len(texts))
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    for low in range(0, len(order), lanes):
        group = order[low : low + lanes]
        sizes = np.array([len(texts[i]) for i in group])
        if not sizes[0]:
            break
        state = np.zeros((h, len(group)), dtype=np.float32)
        last = np.full(len(group), -1)
        end = 0
        while end < sizes[0]:
            begin = end
            width = max(window, window * lanes // int(np.searchsorted(-sizes, -begin, "left")))
            end = min(begin + width, int(sizes[0]))
            width = end - begin
            # Texts are sorted by length, so those that still run come first.
            live = np.searchsorted(-sizes, -(begin + np.arange(width)), "left")
            ids = np.full((width, live[0]), -1)
            for k in range(live[0]):
                piece = texts[group[k]][begin:end]
                ids[: len(piece), k] = piece
            states = np.empty((width, live[0], h), dtype=np.float32)
            before = last
            for t, n in enumerate(live):
                state = _step(gates_of.take(before[:n], axis=0), state[:, :n], carry, h)[0]
                states[t, :n] = state.T
                before = ids[t]
            last = before
            at = np.flatnonzero(ids >= 0)
            found = output_log_probs(p, shape, states.reshape(-1, h).take(at, axis=0), ids.reshape(-1)[at])
            total[np.asarray(group)[: live[0]]] += np.bincount(at % live[0], weights=found, minlength=live[0]) * LOG10
    return total


def _loss_and_error(x: np.ndarray, picked: np.ndarray, n: int, plain: bool = False) -> tuple[float, np.ndarray]:
    """Summed log loss of the picked row in each column, and its slope over ``n`` by the scores ``x``, which are overwritten."""
    at = picked * x.shape[1] + np.arange(len(picked))
    if not plain:
        x -= x.max(axis=0)
    flat = x.reshape(-1)
    chosen = flat.take(at).sum(dtype=np.float64)
    np.exp(x, out=x)
    total = x.sum(axis=0)
    x /= total * n
    flat[at] -= 1 / n
    return float(np.log(total).sum(dtype=np.float64) - chosen), x


def _sums_by_word(words: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct words and the sums of their rows."""
    # Two-byte numbers are sorted by counting.
    order = np.argsort(words.astype(np.uint16) if words.max() < 1 << 16 else words, kind="stable")
    words = words[order]
    heads = np.flatnonzero(np.append(True, words[1:] != words[:-1]))
    counts = np.diff(np.append(heads, len(words)))
    # By falling counts, the words that have a next row come first.
    falling = np.argsort(-counts, kind="stable")
    begins, counts = heads[falling], counts[falling]
    having = np.searchsorted(-counts, -np.arange(FEW + 1)).tolist()  # words of more than so many rows
    many = having[FEW]
    sums = rows.take(order[begins], axis=0)
    ones = np.ones(counts[0], dtype=rows.dtype)
    for i, (low, n) in enumerate(zip(begins[:many].tolist(), counts[:many].tolist(), strict=True)):
        np.matmul(ones[:n], rows.take(order[low : low + n], axis=0), out=sums[i])
    for k in range(1, FEW):
        if having[k] == many:
            break
        sums[many : having[k]] += rows.take(order[begins[many : having[k]] + k], axis=0)
    found = np.empty_like(sums)
    found[falling] = sums
    return words[heads], found


@np.errstate(over="ignore")
def loss_and_slope(flat: np.ndarray, shape: Shape, ids: np.ndarray, before: np.ndarray, state: np.ndarray, block: int = BLOCK) -> tuple:
    """Mean log loss of a window of ids (steps, lanes), its slope, and the last state; scores are held for ``block`` ids at a time.

    ``before`` holds the id before each step, -1 at the start of a text, where the state is cleared.
    """
    p, h = shape.views(flat), shape.hidden
    slope = np.zeros_like(flat)
    g = shape.views(slope)
    steps, lanes = ids.shape
    n = ids.size
    before = np.ascontiguousarray(before)
    went_on = (before >= 0).astype(flat.dtype)
    gates_of, carry = _gate_weights(p, h)
    olds, own = np.empty((steps, h, lanes), dtype=flat.dtype), np.empty((steps, 3 * h, lanes), dtype=flat.dtype)
    states = np.empty((steps, lanes, h), dtype=flat.dtype)
    kept, state = [], state.T
    for t in range(steps):
        np.multiply(state, went_on[t], out=olds[t])
        state, *parts = _step(gates_of.take(before[t], axis=0), olds[t], carry, h, own[t])
        kept.append(parts)
        states[t] = state.T
    class_out, word_out = _with_bias(p["class_out"], p["class_bias"]), _with_bias(p["word_out"], p["word_bias"])
    states = states.reshape(n, h)
    plain, plain_inside = _within_range(class_out, states), _within_range(word_out, states)
    order, rows, group, places = _sorted_by_class(shape, states, ids.reshape(n))
    loss = 0.0
    g_class, g_word = np.zeros_like(class_out.T), np.zeros_like(word_out.swapaxes(1, 2), order="C")
    down_rows = np.empty((n, h), dtype=flat.dtype)
    for low in range(0, n, block):
        some, of, down = rows[low : low + block], group[low : low + block], down_rows[low : low + block]
        more, error = _loss_and_error(class_out.T @ some.T, of, n, plain)
        loss += more
        g_class += error @ some
        np.matmul(error.T, p["class_out"].T, out=down)
        scores, slices = _inner_scores(word_out, some, of)
        more, error = _loss_and_error(scores, places[low : low + scores.shape[1]], n, plain_inside)
        loss += more
        for c, begin, end in slices:
            g_word[c] += error[:, begin:end] @ some[begin:end]
            down[begin:end] += error[:, begin:end].T @ p["word_out"][c].T
    g["class_out"][:], g["class_bias"][:] = g_class[:, :-1].T, g_class[:, -1]
    g["word_out"][:], g["word_bias"][:] = g_word[:, :, :-1].swapaxes(1, 2), g_word[:, :, -1]
    back_to = np.empty_like(order)
    back_to[order] = np.arange(n)
    back = down_rows.take(back_to, axis=0).reshape(steps, lanes, h)
    carried = np.zeros((h, lanes), dtype=flat.dtype)
    # Rows that are not a power of two apart can be read across without pushing each other out of the cache.
    d_own = np.empty((4 * h, lanes + 16), dtype=flat.dtype)[:, :lanes]
    # First the state's share of the fresh state, then the gates; so its weights go round by one place.
    d_inner, d_keep, d_reset, d_fresh = (d_own[i * h : (i + 1) * h] for i in range(4))
    carry, g_carry = np.roll(p["carry"], h, axis=1), np.zeros((3 * h, h), dtype=flat.dtype)
    d_gates = np.empty((steps, lanes, 3 * h), dtype=flat.dtype)
    for t in range(steps - 1, -1, -1):
        keep, reset, inner, fresh = kept[t]
        carried += back[t].T
        left = 1 - keep
        slope_of = fresh * fresh
        np.subtract(1, slope_of, out=slope_of)
        slope_of *= left
        slope_of *= carried
        d_fresh[:] = slope_of
        slope_of *= reset
        d_inner[:] = slope_of
        # The state's share is held times -2.
        rest = reset * 0.5
        rest -= 0.5
        rest *= inner
        np.multiply(rest, slope_of, out=d_reset)
        left *= keep
        left *= carried
        np.subtract(olds[t], fresh, out=rest)
        np.multiply(rest, left, out=d_keep)
        g_carry += d_own[: 3 * h] @ olds[t].T
        d_gates[t] = d_own[h:].T
        carried *= keep
        carried += carry @ d_own[: 3 * h]
        carried *= went_on[t]
    g["carry"][:] = np.roll(g_carry.T, -h, axis=1)
    words, sums = _sums_by_word(before.reshape(n) + 1, d_gates.reshape(n, 3 * h))
    g["first"][:] = sums.sum(axis=0)
    inside = int(words[0] == 0)  # starts of texts
    g["input"][words[inside:] - 1] = sums[inside:]
    return loss / n, slope, state.T


def train_windows(flat: np.ndarray, shape: Shape, texts: list[np.ndarray], rate: float = 0.01, lanes: int = 32, window: int = 16) -> np.ndarray:
    """One pass over the texts, laid end to end on parallel lanes, with Adam; the state is carried from window to window.

    The last lane is filled up from the first texts, so that no token is left out.
    """
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    if not sizes.sum():
        return flat
    flat = flat.copy()
    ids = np.concatenate(texts).astype(np.int64)
    before = np.append(-1, ids[:-1])
    starts = np.cumsum(sizes) - sizes
    before[starts[sizes > 0]] = -1
    lanes = max(1, min(lanes, len(ids) // window))
    per = -(-len(ids) // lanes)
    ids, before = np.resize(ids, lanes * per).reshape(lanes, per).T, np.resize(before, lanes * per).reshape(lanes, per).T
    state = np.zeros((lanes, shape.hidden), dtype=np.float32)
    first, second, step = np.zeros_like(flat), np.zeros_like(flat), np.empty_like(flat)
    for turn, begin in enumerate(range(0, per, window), 1):
        end = min(begin + window, per)
        _, slope, state = loss_and_slope(flat, shape, ids[begin:end], before[begin:end], state)
        size = float(np.sqrt(np.multiply(slope, slope, out=step).sum()))
        if size > 1:
            slope /= size
            np.multiply(slope, slope, out=step)
        step -= second
        step *= 0.01
        second += step
        slope -= first
        slope *= 0.1
        first += slope
        np.divide(second, 1 - 0.99**turn, out=slope)
        np.sqrt(slope, out=slope)
        slope += 1e-6
        np.divide(first, 1 - 0.9**turn, out=step)
        step *= rate * min(1.0, turn / 10)
        step /= slope
        flat -= step
    return flat
