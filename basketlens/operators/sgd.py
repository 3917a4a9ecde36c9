"""One partition's share of a training epoch: mini-batch SGD on Arrow batches.

The model predicts products from h, the mean of a customer's vector and the vectors of its input
products: softmax(W h + b). For "dbow" there are no input products and the targets are the window;
for "dm" the inputs are the window and the target is the product in its middle.
"""

import hashlib

import numpy as np
import pyarrow as pa


def start_values(seed, layer, keys, dim, limit):
    """Start values, one line per key: even between -limit and limit, from the first 4 bytes of the md5 of
    ``seed:layer:key:place``."""
    places = [b":%d" % i for i in range(dim)]
    md5 = hashlib.md5
    digests = []
    for key in keys:
        name = f"{seed}:{layer}:{key}".encode()
        digests += [md5(name + place).digest() for place in places]
    words = np.frombuffer(b"".join(digests), ">u4").reshape(-1, 4)[:, 0]
    unit = words.astype(np.float64) / (1 << 32)
    return ((unit * 2 - 1) * limit).reshape(-1, dim).astype(np.float32)


def minibatches(batches, size):
    """Regroup Arrow batches into tables of ``size`` rows, so that results do not depend on Arrow's batch size."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        while held.num_rows >= size:
            yield held.slice(0, size)
            held = held.slice(size)
    if held is not None and held.num_rows:
        yield held


def matrix(column, dtype):
    """An Arrow list column of equal lengths as a 2-d array."""
    rows = len(column)
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(rows, -1).astype(dtype)


def lists(array):
    """A 2-d float array as an Arrow list column."""
    rows, width = array.shape
    offsets = np.arange(0, rows * width + 1, width, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(array, np.float32).ravel()))


class Nesterov:
    """SGD with Nesterov momentum; the velocity of a row advances only in steps that touch the row."""

    start = 0.0
    divided = True  # copies of a row get equal parts of its state

    def __init__(self, rate, momentum):
        self.rate, self.momentum = rate, momentum

    def step(self, value, velocity, gradient, fresh=None):
        """Change ``value`` and ``velocity`` in place; the output layer is too large to copy in every step.

        ``fresh`` marks rows for which this is not a later part of a step already begun: the parts of a step add up
        to the step as a whole, whose momentum acts once."""
        gradient *= self.rate
        if fresh is None or fresh.all():
            velocity *= self.momentum
            velocity -= gradient
            move = velocity * self.momentum
        else:
            fresh = fresh[:, None]
            velocity *= np.where(fresh, self.momentum, np.float32(1))
            velocity -= gradient
            move = np.where(fresh, velocity, -gradient) * self.momentum
        move -= gradient
        value += move


class Adagrad:
    """SGD whose rate falls, for every number by itself, with the squares of its gradients so far."""

    start = 0.1
    divided = False

    def __init__(self, rate):
        self.rate = rate

    def step(self, value, squares, gradient, fresh=None):
        squares += gradient * gradient
        gradient *= self.rate
        value -= gradient / np.sqrt(squares)


class Gather:
    """Adds the gradients up in the state and leaves the values as they are."""

    def step(self, value, state, gradient, fresh=None):
        state += gradient


class Alias:
    """Draws from weights in constant time: every place holds a share of itself and one other place for the rest."""

    def __init__(self, weights):
        n = len(weights)
        weights = np.asarray(weights, np.float64) + 1e-9 + (0 if np.any(weights) else 1)
        self.chance = weights / weights.sum()
        self.own, self.other = np.ones(n), np.arange(n)
        scaled = self.chance * n
        small, large = list(np.flatnonzero(scaled < 1)), list(np.flatnonzero(scaled >= 1))
        while small and large:
            low, high = small.pop(), large[-1]
            self.own[low], self.other[low] = scaled[low], high
            scaled[high] -= 1 - scaled[low]
            if scaled[high] < 1:
                small.append(large.pop())

    def draw(self, random, size):
        at = random.integers(0, len(self.own), size)
        return np.where(random.random(size) < self.own[at], at, self.other[at])


class Inputs:
    """Input rows that a task holds: values and state by product."""

    def __init__(self, values, state, products, num_prods):
        self.values, self.state = values, state
        self.place = np.full(num_prods, -1)
        self.place[products] = np.arange(len(products))

    def step(self, rule, contexts, back):
        """Every input of an example gets its part ``back`` of the gradient, as often as it occurs."""
        touched, where = np.unique(self.place[contexts], return_inverse=True)
        uses = np.zeros((len(touched), len(back)), back.dtype)
        np.add.at(uses, (where.reshape(contexts.shape), np.broadcast_to(np.arange(len(back))[:, None], contexts.shape)), 1)
        value, state = self.values[touched], self.state[touched]
        rule.step(value, state, uses @ back)
        self.values[touched], self.state[touched] = value, state


class Block:
    """Output rows that a task holds: its own products first, then those that every task holds; the bias comes last.

    A target is compared with the products here. The own ones stand for all that no task shares: next to an own
    target each of them counts for the same part of the others. With ``negatives`` that many draws from the own rows
    stand for them, each weighted by how seldom it would be drawn.
    """

    def __init__(self, values, state, n_own, num_prods, negatives=None, weights=None, seed=()):
        self.values, self.state, self.n_own = values, state, n_own
        others = num_prods - (len(values) - n_own)
        self.beside_own, self.beside_hot = (others - 1) / max(1, n_own - 1), others / max(1, n_own)
        self.negatives = negatives if n_own else None
        if self.negatives:
            self.alias, self.random = Alias(weights), np.random.default_rng(seed)

    def _compared(self, wanted):
        """(rows that take part, how many own ones, their multiplicities, the targets among them); None: all rows."""
        if not self.negatives:
            return None, self.n_own, np.ones(self.n_own, np.float32), wanted
        drawn = self.alias.draw(self.random, self.negatives)
        held = wanted[wanted >= 0]
        rows = np.unique(np.concatenate([drawn, held, np.arange(self.n_own, len(self.values))]))
        n_own = int(np.searchsorted(rows, self.n_own))
        times = np.bincount(np.searchsorted(rows, drawn), minlength=len(rows))[:n_own]
        many = times / (self.negatives * self.alias.chance[rows[:n_own]])
        return rows, n_own, many.astype(np.float32), np.where(wanted >= 0, np.searchsorted(rows, wanted), -1)

    def train(self, rule, vectors, states, inputs, contexts, wanted, size, fresh=None):
        """A step on the ``wanted`` targets (places of rows here, -1 for none), one line per customer.

        ``vectors`` and ``states`` of the customers and all rows change in place; the step is the sum over the
        customers divided by ``size``. Returns the sums of loss and hits over the targets, and their number."""
        n, width = wanted.shape
        share = 1 / (1 + (contexts.shape[1] if inputs else 0))
        hidden = (vectors + inputs.values[inputs.place[contexts]].sum(axis=1)) * share if inputs else vectors * share
        hidden = np.column_stack([hidden, np.ones(n, hidden.dtype)])
        at, n_own, many, wanted = self._compared(wanted)
        values = self.values if at is None else self.values[at]

        grad = hidden @ values.T
        grad -= grad.max(axis=1, keepdims=True)
        np.exp(grad, out=grad)
        row, column = np.nonzero(wanted >= 0)
        target = wanted[row, column]
        own = target < n_own
        found = grad[row, target].astype(np.float64)
        times = np.zeros(len(target))
        times[own] = many[target[own]]
        beside = np.where(own, self.beside_own, self.beside_hot)
        rest = (grad[:, :n_own] @ many).astype(np.float64)[row] - times * found
        total = grad[:, n_own:].sum(axis=1, dtype=np.float64)[row] + beside * np.maximum(rest, 0) + own * found
        total = np.maximum(total, 1e-30)
        prob = found / total
        loss = -np.log(np.maximum(prob, 1e-7)).sum()
        hits = int((grad.argmax(axis=1)[row] == target).sum())

        # Gradient by the logits: what a row stands for times its probability, less the share of the target.
        part = 1.0 / width / size
        grad[:, :n_own] *= many * np.bincount(row, part * beside / total, n).astype(grad.dtype)[:, None]
        grad[:, n_own:] *= np.bincount(row, part / total, n).astype(grad.dtype)[:, None]
        np.add.at(grad, (row, target), (part * (own * (1 - beside * times) * prob - 1)).astype(grad.dtype))
        back = (grad @ values[:, :-1]) * share
        if at is None:
            rule.step(self.values, self.state, grad.T @ hidden)
        else:
            state = self.state[at]
            rule.step(values, state, grad.T @ hidden)
            self.values[at], self.state[at] = values, state
        if inputs:
            inputs.step(rule, contexts, back)
        rule.step(vectors, states, back, fresh)
        return float(loss), hits, len(target)


def train_batch(model, speed, rule, vectors, velocities, inputs, targets, size=None):
    """Update ``model`` and ``speed`` (dicts W, b, E), ``vectors`` and ``velocities`` in place; return loss and hits.

    ``vectors`` and ``velocities`` belong to the batch's customers, ``inputs`` are their input
    products or None, ``targets`` the products to predict, all with one row per customer. The step is the sum over the
    customers divided by ``size``, by their number unless it is given.
    """
    n, width = targets.shape
    share = 1.0 / (1 + (inputs.shape[1] if inputs is not None else 0))
    hidden = vectors * share if inputs is None else (vectors + model["E"][inputs].sum(axis=1)) * share

    prob = hidden @ model["W"].T
    prob += model["b"]
    prob -= prob.max(axis=1, keepdims=True)
    np.exp(prob, out=prob)
    prob /= prob.sum(axis=1, keepdims=True)
    rows = np.broadcast_to(np.arange(n)[:, None], targets.shape)
    loss = -np.log(np.maximum(prob[rows, targets], 1e-7)).sum() / width
    hits = (targets == prob.argmax(axis=1)[:, None]).sum() / width

    # Gradient of the loss by the logits: probabilities minus the share of each target.
    np.subtract.at(prob, (rows, targets), 1.0 / width)
    prob /= size or n
    back = (prob @ model["W"]) * share
    rule.step(model["W"], speed["W"], prob.T @ hidden)
    rule.step(model["b"], speed["b"], prob.sum(axis=0))
    if inputs is not None:
        touched, where = np.unique(inputs, return_inverse=True)
        uses = np.zeros((len(touched), n), back.dtype)
        np.add.at(uses, (where.reshape(inputs.shape), np.broadcast_to(np.arange(n)[:, None], inputs.shape)), 1)
        value, velocity = model["E"][touched], speed["E"][touched]
        rule.step(value, velocity, uses @ back)
        model["E"][touched], speed["E"][touched] = value, velocity
    rule.step(vectors, velocities, back)
    return loss, hits
