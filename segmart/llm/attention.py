"""A small causal self-attention model over subword ids, in numpy.

Every subword id has a learnt vector, added to that of its class of frequency: keys, values
and queries are made of the sum. The output is in two levels: the model predicts the class
of the next subword, and within it a subword has its smoothed share of the counts. A text is
read in windows of `CONTEXT` + `STEP` places that overlap by `CONTEXT`: each place is a
key for the places after it in its window, and the last `STEP` places are queries, so
every subword is scored exactly once, with at least `CONTEXT` places before it where the
text has them. Windows of many texts are computed together, with one mask.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

import numpy as np

CLASSES = 64
SIZE = 16
CONTEXT = 16
STEP = 16
PLACES = CONTEXT + STEP
VECTOR_RATE = 0.05
BLOCK = 256  # windows computed at once, few enough for the cache


@dataclass
class Weights:
    """All that training changes, but for the vectors of the single subwords."""

    embedding: np.ndarray  # class -> vector; one more row for the start of a text
    query: np.ndarray
    key: np.ndarray
    value: np.ndarray
    output: np.ndarray
    distance: np.ndarray  # added to the attention between places so far apart
    readout: np.ndarray  # vector -> class

    @classmethod
    def initial(cls, seed: int = 11) -> Weights:
        random = np.random.default_rng(seed)

        def normal(*shape: int) -> np.ndarray:
            return random.normal(0, 0.5 / np.sqrt(shape[0]), shape).astype(np.float32)

        square = [normal(SIZE, SIZE) for _ in range(4)]
        embedding = random.normal(0, 0.5, (CLASSES + 1, SIZE)).astype(np.float32)
        return cls(embedding, *square, np.zeros(PLACES, np.float32), normal(SIZE, CLASSES))

    def arrays(self) -> list[np.ndarray]:
        return [getattr(self, f.name) for f in fields(self)]

    def flat(self) -> np.ndarray:
        return np.concatenate([a.ravel() for a in self.arrays()])

    @classmethod
    def of_flat(cls, flat: np.ndarray) -> Weights:
        model, place = cls.initial(), 0
        for array in model.arrays():
            array[...] = flat[place : place + array.size].reshape(array.shape)
            place += array.size
        return model


@dataclass
class Windows:
    """Inputs (window, place), targets (window, step) and which of them are real.

    `ids` has the subwords of the inputs, where these are classes.
    """

    inputs: np.ndarray
    input_mask: np.ndarray
    targets: np.ndarray
    target_mask: np.ndarray
    owner: np.ndarray
    ids: np.ndarray | None = None

    def arrays(self) -> list[np.ndarray | None]:
        return [getattr(self, f.name) for f in fields(self)]


def windows_of(
    texts: list[np.ndarray], subwords: list[np.ndarray] | None = None, start: int = 0,
    class_of: np.ndarray | None = None, only: tuple[int, int] | None = None,
) -> Windows:
    """The windows of texts given as class sequences; the start of a text is class CLASSES, and subword `start`.

    With `class_of`, of `start` too, the classes are those of the subwords, and `texts` are not read.
    With `only`, (i, n), these are the windows of round i of n: of each text every n-th, so that all rounds
    have them all. The text's length says where the numbers start, as many texts have one window only.
    """
    sequences = texts if subwords is None else subwords
    lengths = np.array([len(t) for t in sequences], np.int64)
    first = np.cumsum(lengths) - lengths
    counts = -(-lengths // STEP)
    owner = np.repeat(np.arange(len(sequences)), counts)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    if only is not None:
        chosen = np.flatnonzero((number + lengths[owner]) % only[1] == only[0])
        owner, number = owner[chosen], number[chosen]
    left = lengths[owner] - number * STEP
    begins, opening = first[owner] + number * STEP, number == 0
    target_mask = np.arange(STEP) < left[:, None]
    # The input at a place is the subword before it.
    input_mask = np.arange(PLACES) - CONTEXT - 1 < left[:, None]
    input_mask[opening, :CONTEXT] = False

    def rows(parts: list[np.ndarray], before: int) -> np.ndarray:
        """Inputs and, one place later, targets: CONTEXT + 1 places before a window's first target and STEP from it on."""
        dtype = np.uint16 if before < 1 << 16 else np.int64
        flat = np.concatenate([np.zeros(CONTEXT + 1, dtype), *parts, np.zeros(PLACES, dtype)], dtype=dtype, casting="unsafe")
        found = np.lib.stride_tricks.sliding_window_view(flat, PLACES + 1)[begins]
        found[opening, : CONTEXT + 1] = before
        found[number == 1, 0] = before
        return found

    ids = None if subwords is None else rows(subwords, start)
    classes = rows(texts, CLASSES) if class_of is None or ids is None else class_of[ids]
    return Windows(
        classes[:, :PLACES], input_mask, classes[:, CONTEXT + 1 :], target_mask, owner,
        None if ids is None else ids[:, :PLACES],
    )


_DISTANCE = (CONTEXT + np.arange(STEP))[:, None] - np.arange(PLACES)[None]
_CAUSAL = _DISTANCE >= 0
_DISTANCE = np.clip(_DISTANCE, 0, PLACES - 1)


SCALE = np.float32(SIZE**-0.5)
_ONES = np.ones(max(CLASSES, PLACES), np.float32)


def _taken(table: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    return table.take(numbers, axis=0)


def _sums(x: np.ndarray) -> np.ndarray:
    """Sums over the last axis, by a product, which is faster than a sum over short rows."""
    return (x.reshape(-1, x.shape[-1]) @ _ONES[: x.shape[-1]]).reshape(x.shape[:-1])


def _times(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """x @ w for many short rows, some at a time: faster than at once."""
    rows = x.reshape(-1, 8 * STEP if len(x) % (8 * STEP) == 0 else STEP, x.shape[-1])
    return (rows @ w).reshape(len(x), -1)


def _outer(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a.T @ b for many rows, a few parts at a time."""
    a, b = a.reshape(8, -1, a.shape[-1]), b.reshape(8, -1, b.shape[-1])
    return (a.transpose(0, 2, 1) @ b).sum(0)


def _bounded(x: np.ndarray) -> np.ndarray:
    """In place; so that sums of its exponentials are finite."""
    if x.size and not x.max() <= 80:
        np.minimum(x, np.float32(80), out=x)
    return x


def _attended(
    w: Weights, q: np.ndarray, keys: np.ndarray, v: np.ndarray, opening: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Attention before it is divided by its sums, these, and the mean of values; q is scaled, and keys are columns.

    Places before the text are there in `opening` windows only. Places after its end are seen from no target.
    """
    scores = q @ keys
    scores += np.where(_CAUSAL, w.distance[_DISTANCE], np.float32(-1e4))
    np.exp(_bounded(scores), out=scores)
    if len(opening):
        scores[opening, :, :CONTEXT] = 0
    sums = _sums(scores)
    sums += np.float32(1e-30)
    mixed = scores @ v
    mixed /= sums[..., None]
    return scores, sums, mixed


class Scorer:
    """Log probabilities under given weights; what only depends on a subword is computed once for each."""

    def __init__(self, w: Weights, follow: np.ndarray, class_of: np.ndarray, vectors: np.ndarray | None) -> None:
        """`class_of` and `vectors` of all subwords and of the start; without vectors these are the classes."""
        x = w.embedding[class_of]
        if vectors is not None:
            x = x + vectors.astype(np.float32)
        self._w = w
        self._keys_values = x @ np.concatenate([w.key, w.value], axis=1)
        self._queries = x @ (w.query * SCALE)
        self._logits = x @ w.readout + follow[class_of]
        self._rest = w.output @ w.readout

    def log_probabilities(self, windows: Windows) -> np.ndarray:
        """Natural log of each target's class probability; 0 where there is no target."""
        found = np.zeros(windows.targets.shape, np.float32)
        ids = windows.inputs if windows.ids is None else windows.ids
        for start in range(0, len(found), BLOCK):
            part = slice(start, start + BLOCK)
            late = np.ascontiguousarray(ids[part, CONTEXT:])
            both = _taken(self._keys_values, ids[part])
            opening = np.flatnonzero(~windows.input_mask[part, 0])
            keys = np.ascontiguousarray(both[..., :SIZE].transpose(0, 2, 1))
            _, _, mixed = _attended(self._w, _taken(self._queries, late), keys, both[..., SIZE:], opening)
            logits = _times(mixed.reshape(-1, SIZE), self._rest)
            logits += _taken(self._logits, late.ravel())
            chosen = _bounded(logits).ravel().take(np.arange(0, logits.size, CLASSES) + windows.targets[part].ravel())
            found[part] = (chosen - np.log(_sums(np.exp(logits, out=logits)))).reshape(late.shape)
        found[~windows.target_mask] = 0
        return found


def log_probabilities(
    w: Weights, follow: np.ndarray, windows: Windows, vectors: np.ndarray | None = None
) -> np.ndarray:
    """Natural log of each target's class probability; 0 where there is no target.

    `follow` is the log share of each class after each class, from counts, and `vectors` has those of
    the subwords, if windows have ids. Only the first
    window of a text has places before the text; beyond its end nothing is looked at.
    """
    if vectors is None:
        classes = Windows(*windows.arrays()[:5])
        return Scorer(w, follow, np.arange(CLASSES + 1), None).log_probabilities(classes)
    class_of = np.zeros(len(vectors), np.int64)
    class_of[windows.ids[windows.input_mask]] = windows.inputs[windows.input_mask]
    return Scorer(w, follow, class_of, vectors).log_probabilities(windows)


def _gradients(w: Weights, follow: np.ndarray, windows: Windows, part: np.ndarray) -> list[np.ndarray]:
    grads, d_x = _all_gradients(w, follow, windows, part, None)
    grads[0] = _by_class(windows.inputs[part].ravel(), d_x.reshape(-1, SIZE))
    return grads


def _by_class(classes: np.ndarray, d_x: np.ndarray) -> np.ndarray:
    return (classes == np.arange(CLASSES + 1)[:, None]).astype(np.float32) @ d_x


def _all_gradients(
    w: Weights, follow: np.ndarray, windows: Windows, part: np.ndarray, vectors: np.ndarray | None
) -> tuple[list[np.ndarray], np.ndarray]:
    """The gradients of the weights' arrays but the first, the embedding, and that of the inputs' vectors (window, place).

    The embedding's are sums of the latter by class.
    """
    inputs = windows.inputs[part]
    x = _taken(w.embedding, inputs)
    if vectors is not None:
        x += _taken(vectors, windows.ids[part])
    flat_x, n = x.reshape(-1, SIZE), len(inputs)
    late = np.ascontiguousarray(x[:, CONTEXT:]).reshape(-1, SIZE)
    pair = np.concatenate([w.key, w.value], axis=1)
    both = _times(flat_x, pair).reshape(n, PLACES, 2 * SIZE)
    k, v = both[..., :SIZE], both[..., SIZE:]
    columns = np.ascontiguousarray(both.transpose(0, 2, 1))  # products with these are faster than with views
    q = _times(late, w.query * SCALE).reshape(n, STEP, SIZE)
    opening = np.flatnonzero(~windows.input_mask[part, 0])
    attention, sums, mixed = _attended(w, q, columns[:, :SIZE], v, opening)
    mixed = mixed.reshape(-1, SIZE)
    hidden = _times(mixed, w.output)
    hidden += late
    logits = _times(hidden, w.readout)
    logits += _taken(follow, inputs[:, CONTEXT:].ravel())
    error = np.exp(_bounded(logits), out=logits)
    mask = windows.target_mask[part].ravel()
    share = mask / np.float32(max(1, mask.sum()))
    # The error is that of each target times its sum: the smaller arrays are divided by it.
    total = _sums(error)
    error.ravel()[np.arange(0, error.size, CLASSES) + windows.targets[part].ravel()] -= total
    share = (share / total)[:, None]

    d_hidden = _times(error, w.readout.T)
    d_hidden *= share
    d_mixed = _times(d_hidden, w.output.T)
    # The attention was not divided by its sums: what comes back through it is.
    d_output, d_mixed = _outer(mixed, d_hidden), d_mixed / sums.reshape(-1, 1)
    mean = np.einsum("ij,ij->i", d_mixed, mixed).reshape(n, STEP, 1)
    d_mixed = d_mixed.reshape(n, STEP, SIZE)
    d_scores = d_mixed @ columns[:, SIZE:]
    d_scores -= mean
    d_scores *= attention
    d_both = np.empty_like(both)
    np.matmul(attention.transpose(0, 2, 1), d_mixed, out=d_both[..., SIZE:])
    np.matmul(d_scores.transpose(0, 2, 1), q, out=d_both[..., :SIZE])  # q is scaled already
    d_q = (d_scores @ k).reshape(-1, SIZE)
    d_q *= SCALE
    d_both = d_both.reshape(-1, 2 * SIZE)
    d_x = _times(d_both, pair.T).reshape(n, PLACES, SIZE)
    d_late = _times(d_q, w.query.T)
    d_late += d_hidden
    d_x[:, CONTEXT:] += d_late.reshape(n, STEP, SIZE)
    d_pair = _outer(flat_x, d_both)
    by_place = (_ONES[:1].repeat(n) @ d_scores.reshape(n, -1))
    d_distance = np.bincount(_DISTANCE.ravel(), by_place, PLACES).astype(np.float32)
    return [
        np.empty(0, np.float32), _outer(late, d_q), d_pair[:, :SIZE], d_pair[:, SIZE:], d_output, d_distance,
        _outer(hidden * share, error),
    ], d_x


class Trainer:
    """Adam over batches of windows, from given weights on, and Adagrad for the vectors of their subwords."""

    def __init__(self, weights: Weights, follow: np.ndarray, rate: float, vectors: np.ndarray) -> None:
        self.weights, self.follow, self.rate = weights, follow, rate
        self.vectors = vectors.copy()
        self.met = np.zeros(len(vectors), np.int64)  # how often each subword was an input
        self._squares = np.zeros(len(vectors), np.float32)
        self.first = [np.zeros_like(a) for a in weights.arrays()]
        self.second = [np.zeros_like(a) for a in weights.arrays()]
        self.steps = self.seen = 0

    def learn(self, windows: Windows, batch: int = 256) -> None:
        for start in range(0, len(windows.inputs), batch):
            part = slice(start, min(start + batch, len(windows.inputs)))
            self.steps += 1
            self.seen += part.stop - start
            scale = self.rate * np.sqrt(1 - 0.999**self.steps) / (1 - 0.9**self.steps)
            grads, d_x = _all_gradients(self.weights, self.follow, windows, part, self.vectors)
            rows, counts, example, summed = _by_subword(windows.ids[part].ravel(), d_x.reshape(-1, SIZE))
            grads[0] = _by_class(windows.inputs[part].ravel()[example], summed)
            for array, grad, first, second in zip(
                self.weights.arrays(), grads, self.first, self.second, strict=True
            ):
                first += 0.1 * (grad - first)
                second += 0.001 * (grad * grad - second)
                array -= scale * first / (np.sqrt(second) + 1e-8)
            self.met[rows] += counts
            squares = self._squares[rows] + _sums(summed * summed) / np.float32(SIZE)
            self._squares[rows] = squares
            self.vectors[rows] -= VECTOR_RATE * summed / (np.sqrt(squares)[:, None] + np.float32(1e-8))


def _by_subword(ids: np.ndarray, d_x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct subwords, how often each is there, one place of each, and the sum of its rows."""
    order = np.argsort(ids, kind="stable")
    ids = ids[order]
    starts = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
    summed = np.add.reduceat(_taken(d_x, order), starts)
    return ids[starts], np.diff(np.append(starts, len(ids))), order[starts], summed
