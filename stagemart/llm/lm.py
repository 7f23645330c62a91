"""Language-model scores: log-bilinear choices in wide nodes, trained by noise-contrastive estimation, and a unigram base."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagemart.llm.scratch import Scratch
from stagemart.llm.shipping import session_of
from stagemart.llm.words import Block, blocks, mix, row_of, words

#: The token after the last word of a text.
END = mix(np.array([0xE0F], np.uint64))[0]
_LOG2_STEPS = 64
_KEPT_WORDS = 1 << 20
#: Scores up to it, of which one a row is not below its negative, keep their exponentials and the sums of those in range.
_SAFE = 60.0
_ROWS_AT_ONCE = 1 << 12
#: Text that is trained by, or scored, at once: nodes are visited once for all its tokens.
_BLOCK_BYTES = 4 << 20
#: Text that is cut into words at once, and rows of contexts that are moved at once.
_PIECE_BYTES, _PIECE_ROWS = 1 << 18, 1 << 13
#: Squared gradients that an item starts with, so that its first steps are in proportion to what it has seen.
_SEEN = 1000.0


@dataclass(frozen=True)
class ModelOptions:
    """``common`` words at most have vectors and their counts sent to every task, the counts of those beyond are joined.

    A node chooses between ``width`` words or nodes below it. Each of ``shares`` of the training texts is a round,
    after which the tasks that trained in it are averaged; all texts are in one of them. A task takes ``block``
    tokens at once, and steps after ``batch`` of them in the root and ``small_batch`` in the other nodes,
    against ``noise`` samples, at ``rate``.
    """

    common: int = 1 << 18
    dims: int = 16
    width: int = 128
    shares: tuple[float, ...] = (1.0,)
    block: int = 1 << 20
    batch: int = 4096
    small_batch: int = 512
    noise: int = 32
    busy: int = 128
    rate: float = 0.2


def _pieces(block: Block) -> Iterator[Block]:
    """The block in whole texts again, of up to ``_PIECE_BYTES`` where they are no longer."""
    first = 0
    while first < block.rows:
        last = int(np.searchsorted(block.offsets, block.offsets[first] + _PIECE_BYTES, "right")) - 1
        last = max(last, first + 1)
        offsets = block.offsets[first : last + 1]
        yield Block(first, block.data[offsets[0] : offsets[-1]], offsets - offsets[0])
        first = last


class Tokens:
    """Tokens of a block: each text's words, then the end."""

    def __init__(self, block: Block):
        found = [words(piece) for piece in _pieces(block)]
        hashes, counts = (np.concatenate(parts) for parts in ([part.hashes for part in found], [np.diff(part.offsets) for part in found]))
        rows = np.arange(block.rows)
        offsets = np.append(0, np.cumsum(counts))
        self.offsets = offsets + np.append(rows, block.rows)
        self.hashes = np.full(self.offsets[-1], END)
        self.hashes[np.arange(len(hashes)) + row_of(offsets)] = hashes

    def contexts(self, ids: np.ndarray, outside: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids one and two tokens before; ``outside`` before a text."""
        starts = self.offsets[:-1]
        one, two = np.empty_like(ids), np.empty_like(ids)
        one[1:] = ids[:-1]
        one[starts] = outside
        two[1:] = one[:-1]
        two[starts] = outside
        return one, two


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    found, place = np.unique(np.concatenate([part[0] for part in parts]), return_inverse=True)
    return found, np.bincount(place, np.concatenate([part[1] for part in parts])).astype(np.int64)


def _count_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the task's tokens, summed up before they leave it while they fit."""

    def put(parts: list) -> pa.RecordBatch:
        found, count = _merged(parts)
        return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(count)], ["word", "n"])

    held: list[tuple[np.ndarray, np.ndarray]] = []
    total = 0
    for batch in batches:
        for block in blocks(batch.column(0)):
            found, count = np.unique(Tokens(block).hashes, return_counts=True)
            held.append((found, count))
            total += len(found)
            if total > 2 * _KEPT_WORDS:
                held = [_merged(held)]
                total = len(held[0][0])
                if total > _KEPT_WORDS:
                    yield put(held)
                    held, total = [], 0
    if held:
        yield put(held)


@dataclass
class Counts:
    """Counts of the training tokens: all as a table (word, n), and the most frequent ones in order of their hash."""

    table: DataFrame
    tokens: int
    distinct: int
    common: np.ndarray
    common_counts: np.ndarray


def count_tokens(texts: DataFrame, scratch: Scratch, common: int) -> Counts:
    """Count all tokens of the one column of ``texts``."""
    table = scratch.keep(texts.mapInArrow(_count_tokens, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "counts")
    # how frequent a word must be to be common, from a histogram of bounded size
    level = F.floor(F.log2("n") * _LOG2_STEPS).cast("int")
    levels = table.groupBy(level.alias("level")).agg(F.count("*").alias("words"), F.sum("n").alias("tokens")).collect()
    least, held = None, 0
    for row in sorted(levels, key=lambda row: -row.level):
        held += row.words
        if held > common:
            break
        least = row.level
    chosen = table.where(level >= least) if least is not None else table.limit(0)
    told = sum(row.words for row in levels if least is not None and row.level >= least)
    if common > told:  # the most frequent of the next level, up to the bound
        rest = table if least is None else table.where(level < least)
        chosen = chosen.union(rest.orderBy(F.desc("n"), "word").limit(common - told))
    found = chosen.toArrow()
    order = np.argsort(np.asarray(found["word"], np.int64).view(np.uint64))
    return Counts(
        table, sum(row.tokens for row in levels), sum(row.words for row in levels),
        np.asarray(found["word"], np.int64).view(np.uint64)[order], np.asarray(found["n"], np.int64)[order],
    )


class Lookup:
    """Positions of hashes in a sorted array; its length for those that are not in it.

    A table by the first bits of a hash, of about two to four entries a hash, tells where to begin; the hashes are mixed, so few steps are left.
    """

    def __init__(self, sorted_hashes: np.ndarray):
        self.hashes = sorted_hashes
        bits = max(1, (2 * len(sorted_hashes)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.begin = np.searchsorted(sorted_hashes >> self.shift, np.arange(1 << bits, dtype=np.uint64))
        self.padded = np.append(sorted_hashes, np.uint64((1 << 64) - 1))

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        at = self.begin.take((hashes >> self.shift).view(np.int64))
        held = self.padded.take(at)
        left = np.flatnonzero(held < hashes)
        while len(left):
            at[left] += 1
            held[left] = self.padded.take(at[left])
            left = left[held[left] < hashes[left]]
        at[held != hashes] = len(self.hashes)
        return at


class Tree:
    """A Huffman tree of ``width``: each node chooses between that many words or nodes, frequent words near the root.

    ``items`` are words and nodes but the root; those of one node lie side by side, from ``first`` of it on.
    ``item`` gives the item of each word, ``above`` the node that an item lies in, ``own`` the item of each
    node, -1 of the root, which is the last. ``weight`` counts what a node holds, ``share`` is the share of an item in its node.
    ``place`` numbers the words in the order in which the tree holds them, in each node its words before those of its nodes, which rise by weight:
    those of an item begin at ``begin`` of it, those of a node end at ``end`` of it, and ``by_place`` has the items of a node in that order.
    """

    def __init__(self, counts: np.ndarray, width: int):
        words = len(counts)
        order = np.argsort(counts, kind="stable")
        light, weight = counts[order].tolist(), []
        leaf, inner, members = 0, 0, []
        merged = max(2, (words - 2) % (width - 1) + 2) if words > 1 else 1  # so that all later nodes are full
        while not members or leaf < words or inner < len(weight) - 1:
            held, own = 0, []
            for _ in range(merged):  # the lightest: words by weight, and nodes, which arise by weight
                if leaf < words and (inner == len(weight) or light[leaf] <= weight[inner]):
                    own.append(int(order[leaf]))
                    held += light[leaf]
                    leaf += 1
                else:
                    own.append(words + inner)
                    held += weight[inner]
                    inner += 1
            members.append(own)
            weight.append(held)
            merged = width
        place = np.concatenate([np.array(own) for own in members])
        self.nodes, self.width = len(members), width
        self.first = np.concatenate([[0], np.cumsum([len(own) for own in members])])
        self.above = np.repeat(np.arange(self.nodes, dtype=np.uint16 if self.nodes < 1 << 16 else np.int64), np.diff(self.first))
        at = np.full(words + self.nodes, -1, np.int64)
        at[place] = np.arange(len(place))
        self.item, self.own = at[:words], at[words:]
        self.weight = np.array(weight)
        self.share = np.concatenate([counts, self.weight])[place] / self.weight[self.above]
        held = np.ones(len(place), np.int64)  # the words of each item
        for node in range(self.nodes - 1):
            held[self.own[node]] = held[self.first[node] : self.first[node + 1]].sum()
        self.by_place = np.lexsort((np.isin(np.arange(len(place)), self.own[:-1]), self.above))
        self.begin, self.end = np.empty(len(place), np.int64), np.empty(self.nodes, np.int64)
        for node in range(self.nodes - 1, -1, -1):  # those above come first
            items = self.by_place[self.first[node] : self.first[node + 1]]
            ends = np.cumsum(held[items]) + (self.begin[self.own[node]] if self.own[node] >= 0 else 0)
            self.begin[items], self.end[node] = ends - held[items], ends[-1]
        self.place = self.begin[self.item]

    def cuts(self, node: int, ends: np.ndarray) -> np.ndarray:
        """Where the tokens of each item of a node start, by place, and the last ones end; ``ends`` counts the tokens before each place."""
        return np.append(ends[self.begin[self.by_place[self.first[node] : self.first[node + 1]]]], ends[self.end[node]])


def _counted(places: np.ndarray, number: int) -> np.ndarray:
    """How many lie before each of so many places."""
    return np.concatenate([[0], np.cumsum(np.bincount(places, minlength=number))])


class LogBilinear:
    """In a node, P(item | one, two) is proportional to exp((c1 * r[one] + c2 * r[two]) . q[item] + b[item]).

    A word's probability is the product of the choices on the way to it. Contexts are the words, the
    class of all others, and what lies before a text.
    """

    def __init__(self, tree: Tree, dims: int, rows: np.ndarray):
        self.tree, self.dims, self.contexts = tree, dims, len(tree.item) + 1
        self.context = np.ascontiguousarray(rows[: self.contexts, :dims], np.float32)
        self.weights = rows[self.contexts : self.contexts + 2, :dims].astype(np.float32)
        self.items = np.ascontiguousarray(rows[self.contexts + 2 :], np.float32)

    @staticmethod
    def initial(tree: Tree, dims: int) -> np.ndarray:
        """All parameters, one context, weight or item a row, an item's bias last: small random vectors, and biases that make unigram shares."""
        random = np.random.default_rng(7)
        contexts = len(tree.item) + 1
        rows = np.zeros((contexts + 2 + len(tree.share), dims + 1), np.float32)
        rows[:contexts, :dims] = random.normal(0, 0.1, (contexts, dims))
        rows[contexts : contexts + 2, :dims] = 1
        rows[contexts + 2 :, :dims] = random.normal(0, 0.1, (len(tree.share), dims))
        rows[contexts + 2 :, dims] = np.log(tree.share)
        return rows

    @property
    def rows(self) -> np.ndarray:
        contexts, weights = (np.column_stack([part, np.zeros(len(part), np.float32)]) for part in (self.context, self.weights))
        return np.concatenate([contexts, weights, self.items])

    def predicted(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """With a one for the bias at the end."""
        out = np.empty((len(one), self.dims + 1), np.float32)
        out[:, -1] = 1
        for start in range(0, len(one), _ROWS_AT_ONCE):
            some = slice(start, start + _ROWS_AT_ONCE)
            out[some, :-1] = self.joined(self.context.take(one[some], axis=0), self.context.take(two[some], axis=0))
        return out

    def joined(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        return first * self.weights[0] + second * self.weights[1]

    def climb(self, item: np.ndarray, within: np.ndarray | None = None) -> Iterator[list[tuple[int, np.ndarray, np.ndarray]]]:
        """The choices from the items up: lists of (node, rows, the item chosen, numbered in the node). Ends at a node not ``within``."""
        tree, rows = self.tree, np.arange(len(item))
        while True:
            node = tree.above[item]
            if within is not None:
                rows, item, node = rows[within[node]], item[within[node]], node[within[node]]
            if not len(rows):
                return
            order = np.argsort(node, kind="stable")
            rows, item, node = rows[order], item[order], node[order]
            cuts = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1], [True]]))
            yield [(int(node[low]), rows[low:high], item[low:high] - tree.first[node[low]]) for low, high in zip(cuts[:-1], cuts[1:])]
            item = tree.own[node]
            rows, item = rows[item >= 0], item[item >= 0]

    def score(self, one: np.ndarray, two: np.ndarray, words: np.ndarray, at_once: int = 1 << 9) -> np.ndarray:
        """Log10 probabilities of ``words``, each choice normalised over its node by batched matrix products.

        In the order of the tree, the tokens of every node lie side by side.
        """
        tree = self.tree
        place = tree.place.take(words)
        order, ends = np.argsort(place), _counted(place, len(tree.item))
        predicted, total = self.predicted(one.take(order), two.take(order)), np.zeros(len(words))
        held, ones, rows = np.empty((at_once, tree.width), np.float32), np.ones(tree.width, np.float32), np.arange(at_once)
        for node in np.flatnonzero(ends[tree.end] > ends[tree.begin[tree.by_place[tree.first[:-1]]]]):
            cuts = tree.cuts(node, ends)
            low, high = tree.first[node], tree.first[node + 1]
            items, chosen = self.items[low:high], np.repeat(tree.by_place[low:high] - low, np.diff(cuts))
            for start in range(0, len(chosen), at_once):
                own = chosen[start : start + at_once]
                some = slice(cuts[0] + start, cuts[0] + start + len(own))
                scores = held.ravel()[: len(own) * len(items)].reshape(len(own), len(items))
                np.matmul(predicted[some], items.T, out=scores)
                found = scores[rows[: len(own)], own]
                if scores.max() > _SAFE or found.min() < -_SAFE:
                    most = scores.max(axis=1)
                    scores -= most[:, None]
                    found -= most
                total[some] += found - np.log(np.exp(scores, out=scores) @ ones[: len(items)])
        scored = np.empty(len(words))
        scored[order] = total / np.log(10)
        return scored


class Trainer:
    """Stochastic gradients of the noise-contrastive objective, each parameter at its own rate.

    In each node, a choice that was made is told from samples of the node's noise, its flattened shares;
    tokens of a batch share the samples, so that scores and gradients are matrix products. Busy nodes, that hold
    one in ``busy`` of all tokens, learn together with the contexts; the others from a
    block of tokens at once, grouped by node, and what they ask of the contexts is done in one step.
    """

    def __init__(self, model: LogBilinear, options: ModelOptions, seed: int):
        self.model, self.options, self.random = model, options, np.random.default_rng(seed)
        tree = model.tree
        noise = tree.share**0.75
        noise /= np.add.reduceat(noise, tree.first[:-1])[tree.above]
        self.reach = np.cumsum(noise)  # to draw from; a node begins where the one before it ends, at a whole number
        self.log_noise = np.log(np.minimum(options.noise, np.diff(tree.first))[tree.above] * noise).astype(np.float32)
        self.seen_context, self.seen_below, self.seen_weights = np.ones_like(model.context), np.ones_like(model.context), np.ones_like(model.weights)
        self.seen_items = np.full_like(model.items, _SEEN)
        self.context_steps, self.item_steps = np.zeros(len(model.context), np.int64), np.zeros(len(model.items), np.int64)
        self.busy = tree.weight * options.busy >= tree.weight[-1]
        below = tree.own[np.flatnonzero(self.busy[:-1])]  # the items of busy nodes, which are the last ones by place of the node above
        self.split = {int(node): tree.begin[below[tree.above[below] == node]].min(initial=tree.end[node]) for node in np.flatnonzero(self.busy)}

    def choices(self, node: int, predicted: np.ndarray, chosen: np.ndarray, ordered: bool = False) -> np.ndarray:
        """Train one node by the items ``chosen`` in it, ``ordered`` if equal ones lie side by side; the gradient of what was predicted."""
        low, high = self.model.tree.first[node], self.model.tree.first[node + 1]
        if high - low == 1:
            return np.zeros((len(predicted), self.options.dims), np.float32)
        items, log_noise = self.model.items[low:high], self.log_noise[low:high]
        count = min(self.options.noise, high - low)
        drawn = np.searchsorted(self.reach[low : high - 1], node + self.random.random(count))
        goal, against = items.take(chosen, axis=0), items.take(drawn, axis=0)
        with np.errstate(over="ignore"):  # beyond the largest number, the choice is certain
            beyond = against.copy()
            beyond[:, -1] -= log_noise[drawn]
            push = predicted @ np.negative(beyond, out=beyond).T
            np.exp(push, out=push)
            np.reciprocal(np.add(push, 1, out=push), out=push)
            pull = -1 / (1 + np.exp(np.einsum("ij,ij->i", predicted, goal) - log_noise[chosen]))
        back = push @ against
        goal *= pull[:, None]
        back += goal
        if ordered and len(predicted) > 2 * (high - low):
            gradient = np.zeros_like(items)
            first = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
            gradient[chosen[first]] = np.add.reduceat(predicted * pull[:, None], first, axis=0)
        else:
            told = np.zeros((high - low, len(predicted)), np.float32)
            told[chosen, np.arange(len(predicted))] = pull
            gradient = told @ predicted
        np.add.at(gradient, drawn, push.T @ predicted)
        self.item_steps[low:high] += np.bincount(np.concatenate([chosen, drawn]), minlength=high - low)
        seen = self.seen_items[low:high]
        seen += gradient * gradient
        gradient *= self.options.rate
        items -= np.divide(gradient, np.sqrt(seen), out=gradient)
        return back[:, :-1]

    def block(self, one: np.ndarray, two: np.ndarray, words: np.ndarray) -> None:
        """Train by tokens in random order: the nodes that are not busy, then the others and the contexts in batches."""
        model, options, tree = self.model, self.options, self.model.tree
        node = tree.above.take(tree.item.take(words))
        some = np.flatnonzero(~self.busy[node])
        some = some[np.argsort(node[some], kind="stable")]  # by node, so that what is read for one lies side by side
        first, second = one.take(some), two.take(some)
        predicted, back = model.predicted(first, second), np.zeros((len(some), options.dims), np.float32)
        for level in model.climb(tree.item.take(words.take(some)), ~self.busy):
            for node, rows, chosen in level:
                for start in range(0, len(rows), options.small_batch):
                    own = rows[start : start + options.small_batch]
                    back[own] += self.choices(node, predicted.take(own, axis=0), chosen[start : start + options.small_batch])
        self._step_contexts(first, second, back, self.seen_below)
        for start in range(0, len(words), options.batch):
            self._batch(one[start : start + options.batch], two[start : start + options.batch], words[start : start + options.batch])

    def _batch(self, one: np.ndarray, two: np.ndarray, words: np.ndarray) -> None:
        """Train the busy nodes, each by its part of the tokens in the order of the tree, and the contexts."""
        model, options, tree = self.model, self.options, self.model.tree
        place = tree.place.take(words)
        order = np.argsort(place)
        one, two, place = one.take(order), two.take(order), place.take(order)
        first, second = model.context.take(one, axis=0), model.context.take(two, axis=0)
        predicted, back = np.ones((len(one), options.dims + 1), np.float32), np.zeros((len(one), options.dims), np.float32)
        predicted[:, :-1] = model.joined(first, second)
        for node, split in self.split.items():  # a step for what ends here or in nodes that are not busy, one for what goes on
            items = tree.by_place[tree.first[node] : tree.first[node + 1]]
            begin = tree.begin[items]
            ends = np.searchsorted(place, (begin[0], split, tree.end[node]))
            for some in (slice(ends[0], ends[1]), slice(ends[1], ends[2])):
                if some.start < some.stop:
                    chosen = items[np.searchsorted(begin, place[some], "right") - 1] - tree.first[node]
                    back[some] += self.choices(node, predicted[some], chosen, ordered=True)
        to_weights = np.stack([np.einsum("ij,ij->j", back, first), np.einsum("ij,ij->j", back, second)])
        self._step_contexts(one, two, back, self.seen_context)
        self.seen_weights += to_weights * to_weights
        model.weights -= options.rate * to_weights / np.sqrt(self.seen_weights)

    def _step_contexts(self, one: np.ndarray, two: np.ndarray, to_predicted: np.ndarray, seen: np.ndarray) -> None:
        if not len(one):
            return
        bits = (2 * len(one)).bit_length()
        keys = np.concatenate([one, two]) << bits
        keys |= np.arange(len(keys))
        keys.sort()
        rows, order = keys >> bits, keys & ((1 << bits) - 1)
        first = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
        times, rows = np.diff(first, append=len(rows)), rows[first]
        self.context_steps[rows] += times
        marks = np.unique(np.append(np.searchsorted(first, np.arange(0, len(order), _PIECE_ROWS)), len(first)))  # where pieces of whole contexts start
        for low, high in zip(marks[:-1], marks[1:]):
            own = order[first[low] : first[high - 1] + times[high - 1]]
            side = own >= len(one)
            gradient = to_predicted.take(own - len(one) * side, axis=0)
            gradient *= self.model.weights.take(side, axis=0)
            self._step_rows(rows[low:high], times[low:high], gradient, seen)

    def _step_rows(self, rows: np.ndarray, times: np.ndarray, gradient: np.ndarray, seen: np.ndarray) -> None:
        """Move contexts; the gradients of each lie side by side, ``times`` of them."""
        summed = gradient.take(np.cumsum(times) - times, axis=0)
        often = np.flatnonzero(times > 1)
        if len(often):  # the others are their own sums
            several = gradient.take(np.flatnonzero(np.repeat(times > 1, times)), axis=0)
            summed[often] = np.add.reduceat(several, np.cumsum(times[often]) - times[often], axis=0)
        held = seen.take(rows, axis=0)
        held += summed * summed
        seen[rows] = held
        summed *= self.options.rate
        summed /= np.sqrt(held, out=held)
        self.model.context[rows] = self.model.context.take(rows, axis=0) - summed


def _trained(shared, options: ModelOptions, seed: int):
    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, tree, rows = shared.value
        lookup = Lookup(common)
        trainer = Trainer(LogBilinear(tree, options.dims, rows), options, seed)
        total = 0
        for batch in batches:
            for block in blocks(batch.column(0), _BLOCK_BYTES):
                tokens = Tokens(block)
                ids = lookup(tokens.hashes)
                one, two = tokens.contexts(ids, len(common) + 1)
                order = trainer.random.permutation(len(ids))
                for start in range(0, len(order), options.block):
                    some = order[start : start + options.block]
                    trainer.block(one[some], two[some], ids[some])
                total += len(ids)
        if total:
            weight = np.concatenate([trainer.context_steps, np.full(2, total), trainer.item_steps])
            places = np.flatnonzero(weight)
            moved = trainer.model.rows
            for number, lo, hi in _parts(places):
                yield _packed(iter([(number, places[lo:hi], weight[places[lo:hi]], moved[places[lo:hi]])]))

    return train


_MOVED = "part long, places binary, weights binary, rows binary"


def _parts(places: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Where the places of each so many rows start and end."""
    for number in np.unique(places // _ROWS_AT_ONCE):
        yield int(number), *np.searchsorted(places, (number * _ROWS_AT_ONCE, (number + 1) * _ROWS_AT_ONCE))


def _packed(parts: Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    columns = list(zip(*((number, places.astype(np.int64).tobytes(), weights.astype(np.int64).tobytes(), rows.astype(np.float32).tobytes()) for number, places, weights, rows in parts)))
    return pa.RecordBatch.from_arrays([pa.array(columns[0]), *(pa.array(column, pa.binary()) for column in columns[1:])], ["part", "places", "weights", "rows"])


def _unpacked(batch: pa.RecordBatch | pa.Table, width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    for number, places, weights, rows in zip(*(batch[name].to_pylist() for name in ("part", "places", "weights", "rows"))):
        yield number, np.frombuffer(places, np.int64), np.frombuffer(weights, np.int64), np.frombuffer(rows, np.float32).reshape(-1, width)


def _averaged(width: int):
    def average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for number, places, weights, rows in _unpacked(batch, width):
                weight, total = sums.setdefault(number, (np.zeros(_ROWS_AT_ONCE, np.int64), np.zeros((_ROWS_AT_ONCE, width))))
                own = places - number * _ROWS_AT_ONCE
                weight[own] += weights
                total[own] += rows * weights[:, None].astype(np.float64)
        for number, (weight, total) in sums.items():
            own = np.flatnonzero(weight)
            yield _packed(iter([(number, own + number * _ROWS_AT_ONCE, weight[own], total[own] / weight[own, None])]))

    return average


def train_model(texts: DataFrame, common: np.ndarray, tree: Tree, options: ModelOptions) -> np.ndarray:
    """Rows of parameters after a pass over the one column of ``texts``, cut into a round for each of the ``shares``.

    After a round, a row is averaged over the tasks that moved it, by how often they did; tasks send no
    other rows. Tasks are the splits of the input, so that each is bounded and a lost one costs little. The texts
    of a round are chosen by a hash of their content.
    """
    rows = LogBilinear.initial(tree, options.dims)
    context, steps, done = session_of(texts).sparkContext, 1 << 20, 0
    drawn = F.pmod(F.xxhash64(F.lit(5), texts[texts.columns[0]]), F.lit(steps))
    ends = [round(steps * sum(options.shares[: number + 1]) / sum(options.shares)) for number in range(len(options.shares))]
    for number, end in enumerate(ends):
        shared = context.broadcast((common, tree, rows))
        moved = texts.where((drawn >= done) & (drawn < end)).mapInArrow(_trained(shared, options, number), _MOVED)
        found = moved.repartition("part").mapInArrow(_averaged(options.dims + 1), _MOVED).toArrow()
        shared.destroy()
        rows, done = rows.copy(), end
        for _, places, _, values in _unpacked(found, options.dims + 1):
            rows[places] = values
    return rows


_models: dict[str, LogBilinear] = {}

_SCORED = (
    "row long, id long, learned boolean, n_tokens long, known long, common_log double, model_log double,"
    " rare array<struct<word:long,times:int>>"
)

_SCORED_NAMES = ["row", "id", "learned", "n_tokens", "known", "common_log", "model_log", "rare"]


def _scored(shared, dims: int):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, common, counts, tree, rows = shared.value
        lookup = Lookup(common)
        if name not in _models:
            _models.clear()
            _models[name] = LogBilinear(tree, dims, rows)
        model = _models[name]
        logs = np.append(np.log10(counts + 1.0), 0)
        for batch in batches:
            for block in blocks(batch.column(3), _BLOCK_BYTES):
                tokens = Tokens(block)
                ids = lookup(tokens.hashes)
                one, two = tokens.contexts(ids, len(common) + 1)
                each = model.score(one, two, ids)
                starts = tokens.offsets[:-1]
                told = ids < len(common)
                sums = [np.add.reduceat(part, starts) for part in (told.astype(np.int64), logs[ids], each)]
                rare = np.flatnonzero(~told)
                row = np.searchsorted(tokens.offsets, rare, "right") - 1
                order = np.lexsort((tokens.hashes[rare], row))
                row, hashes = row[order], tokens.hashes[rare][order]
                first = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1])])) if len(row) else row
                times = np.diff(np.append(first, len(row)))
                entries = pa.StructArray.from_arrays([pa.array(hashes[first].view(np.int64)), pa.array(times, pa.int32())], ["word", "times"])
                offsets = np.searchsorted(row[first], np.arange(block.rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(index).slice(block.first, block.rows) for index in range(3)), pa.array(np.diff(tokens.offsets)), pa.array(sums[0]), pa.array(sums[1]),
                        pa.array(sums[2]), pa.ListArray.from_arrays(pa.array(offsets), entries),
                    ],
                    _SCORED_NAMES,
                )

    return score


def score_texts(
    documents: DataFrame, learn_from: Column, id_column: str = "doc_id", text_column: str = "text", options: ModelOptions = ModelOptions()
) -> DataFrame:
    """(id, learned, n_tokens, n_known, train_tokens, base_score, score) for each row; learns where ``learn_from`` holds.

    Tokens are the words between blanks, A to Z in lower case, and one end; a null text has the end
    alone. ``base_score`` is the sum of log10((c + 1) / (N + V + 1)) over tokens: count in, size and
    distinct tokens of the training texts. ``score`` is the log10 probability of the text under the
    log-bilinear model: each token's is the product of the choices on the way to it in a wide Huffman
    tree, each normalised over its node. Words beyond the ``common`` ones are one item of it, and within it
    have their unigram shares with one for all unseen words. Without training texts every
    token is unseen: the base is 0 and so is the score. The model, and so ``score``, depends on how the
    input is cut into tasks, as these train side by side; the counts and the base do not.

    All counts and all training tokens are used. A word is known by a 64-bit hash. Counts and vectors of at most
    ``common`` words are sent to the tasks; the rest of a text's words, each as often as it differs,
    are joined with the table of counts, in which no frequent word is left to be skewed. Repeated
    rows are scored each.
    """
    spark = session_of(documents)
    scratch = Scratch(spark, "lm")
    rows = documents.select(
        F.col(id_column).alias("id"), F.coalesce(learn_from, F.lit(False)).alias("learned"), F.col(text_column).cast("binary").alias("text")
    )
    training = rows.where("learned").select("text")
    counts = count_tokens(training, scratch, options.common)
    told = int(counts.common_counts.sum())
    beyond = counts.tokens - told + counts.distinct - len(counts.common) + 1
    tree = Tree(np.append(counts.common_counts, beyond), options.width)
    values = train_model(training, counts.common, tree, options)

    shared = spark.sparkContext.broadcast((scratch.folder, counts.common, counts.common_counts, tree, values))
    texts = rows.select(F.monotonically_increasing_id().alias("row"), F.col("id").cast("long").alias("id"), "learned", "text")
    scored = scratch.keep(texts.mapInArrow(_scored(shared, options.dims), _SCORED), "scored")
    entries = scored.select("row", F.explode("rare").alias("entry")).select("row", F.col("entry.word").alias("word"), "entry.times")
    rare = entries.join(counts.table, "word").groupBy("row").agg(
        F.sum("times").alias("rare_known"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("rare_log")
    )
    found = scored.drop("rare").join(rare, "row", "left").na.fill(0, ["rare_known", "rare_log"])
    all_shares = float(np.log10(counts.tokens + counts.distinct + 1))
    beyond_shares = float(np.log10(beyond))
    return found.select(
        "id", "learned", "n_tokens", (F.col("known") + F.col("rare_known")).alias("n_known"), F.lit(counts.tokens).cast("long").alias("train_tokens"),
        (F.col("common_log") + F.col("rare_log") - F.col("n_tokens") * all_shares).alias("base_score"),
        (F.col("model_log") + F.col("rare_log") - (F.col("n_tokens") - F.col("known")) * beyond_shares).alias("score"),
    )
