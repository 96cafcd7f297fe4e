"""Adaptive context-mixing range coder for blocks of token ids, all lanes of a block in step.

The probability of an id is a mixture of three predictions: order 2 and order 1 name the id
that followed the last two ids and the last id, order 0 is the distribution of all ids so
far. How much each weighs is learned as well, from how often predictions of the same
confidence were right. A range coder turns the mixture into code.

A block starts from an empty model, carries a checksum and is decoded without any other. Its
ids are cut into lanes, each with a code of its own; at each step the lanes code one id each
by the same model, which then learns from all of them. An operation of the coder is thus one
array operation over the lanes. All numbers are whole, so every machine decodes alike.
"""

from __future__ import annotations

import zlib

import numpy as np

BLOCK = 1 << 20  # ids of a block, about
STEPS = 256  # ids of a lane in a large block

SYMBOL_BITS = 16  # leading bits of an id that are predicted by the mixture
REST_BITS = 16  # both probabilities that the other bits are those the symbol had last
TOTAL_BITS = 26  # all probabilities together
PLAIN_BITS = 20  # all probabilities of order 0 together, and the least weight of order 0
HASH_BITS = 18  # slots of order 2
SURE_BITS = 3
SURE = 1 << SURE_BITS  # degrees of confidence, the first for a context not met before
GAIN = 32  # what an id met weighs against one not met
AGED = 1 << 16  # cases after which those of a confidence are halved
REFRESH = 16  # steps between sums of order 0, once 16 have passed
SLOT_BITS = 4  # places of order 0 that share a slot of the guide to their ids

# By 2 * confidence + hit: what is added to a context's id and confidence where the id stays.
_CHANGE = np.array([[max(k >> 1, 1) - k, min(k + 1, SURE - 1) - k] for k in range(SURE)]).ravel()

_HALF = np.uint64(32)
_LOW = np.uint64(0xFFFFFFFF)


class _Model:
    """What a block has told so far."""

    def __init__(self, lanes: int, symbols: int):
        self.symbols = symbols
        # The id that a context predicts, and how sure it is.
        self.one = np.zeros(symbols, np.int32)
        self.two = np.zeros(1 << HASH_BITS, np.int32)
        # Cases of every pair of confidences, without and with agreement: neither was right,
        # order 1, order 2, both.
        self.cases = np.tile(np.array([6, 1, 1, 0], np.int64), (SURE * SURE * 2, 1))
        self.before = np.zeros(lanes, np.int64)
        self.last = np.zeros(lanes, np.int64)
        self.counts = np.ones(symbols, np.int64)
        self.news: list[np.ndarray] = []
        self.rest = np.zeros(symbols, np.int64)
        self.same, self.rests = 1, 2
        self.steps = 0
        self._sum()

    def _sum(self) -> None:
        """Ends of the ids' shares of order 0; every id has one."""
        if self.news:
            self.counts += GAIN * np.bincount(np.concatenate(self.news), minlength=self.symbols)
            self.news = []
        free = (1 << PLAIN_BITS) - self.symbols
        shares = 1 + self.counts * free // int(self.counts.sum())
        self.ends = np.zeros(self.symbols + 1, np.int64)
        np.cumsum(shares, out=self.ends[1:])
        self.ends[-1] = 1 << PLAIN_BITS
        self.guide = None

    def look(self, n: int) -> None:
        """Predictions of the first ``n`` lanes and their weights."""
        last = self.last[:n]
        self.at2 = ((last * 0x9E3779B1 + self.before[:n] * 0x85EBCA77) >> 9) & ((1 << HASH_BITS) - 1)
        self.held1 = self.one.take(last).astype(np.int64)
        self.held2 = self.two.take(self.at2).astype(np.int64)
        self.s1, self.s2 = self.held1 & (SURE - 1), self.held2 & (SURE - 1)
        self.p1, self.p2 = self.held1 >> SURE_BITS, self.held2 >> SURE_BITS
        self.case = (self.s2 * SURE + self.s1) * 2 + (self.p1 == self.p2)
        most = (1 << TOTAL_BITS) - (1 << PLAIN_BITS)
        all_cases = self.cases.sum(axis=1)
        # Where both agree, the weight is that of order 2.
        weight1 = most * self.cases[:, 1] // all_cases
        weight1[1::2] = 0
        weight2 = most * (self.cases[:, 2] + self.cases[:, 3]) // all_cases
        weight0 = (1 << TOTAL_BITS) - weight1 - weight2
        self.w0, self.w1, self.w2 = (w.take(self.case) for w in (weight0, weight1, weight2))

    def place(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and size of each lane's id in the mixture."""
        low = self.w0 * self.ends.take(ids) >> PLAIN_BITS
        size = (self.w0 * self.ends.take(ids + 1) >> PLAIN_BITS) - low
        low += self.w1 * (self.p1 < ids) + self.w2 * (self.p2 < ids)
        size += self.w1 * (self.p1 == ids) + self.w2 * (self.p2 == ids)
        return low, size

    def find(self, places: np.ndarray) -> np.ndarray:
        """The id at each lane's place in the mixture."""
        return self.found(places)[0]

    def found(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The id at each lane's place in the mixture, and the id's start and size there."""
        p1, p2, w0, w1, w2 = self.p1, self.p2, self.w0, self.w1, self.w2
        # Where both predictions agree, w1 is 0 and the share of the second holds the first's.
        above = w2 * (p2 < p1)
        low1 = (w0 * self.ends.take(p1) >> PLAIN_BITS) + above
        end1 = (w0 * self.ends.take(p1 + 1) >> PLAIN_BITS) + above + w1
        above = w1 * (p1 < p2)
        low2 = (w0 * self.ends.take(p2) >> PLAIN_BITS) + above
        end2 = (w0 * self.ends.take(p2 + 1) >> PLAIN_BITS) + above + w2
        past1, past2 = places >= end1, places >= end2
        second = (places >= low2) & ~past2
        ids = np.where(second, p2, p1)
        low = np.where(second, low2, low1)
        size = np.where(second, end2, end1) - low
        at = np.flatnonzero(~second & (past1 | (places < low1)))
        w0 = w0[at]
        taken = w1[at] * past1[at] + w2[at] * past2[at]
        place = (places[at] - taken).astype(np.uint64)
        share = (((place + np.uint64(1)) << np.uint64(PLAIN_BITS)) - np.uint64(1)) // w0.astype(np.uint64)
        other = self._at(share.astype(np.int64))
        begin = w0 * self.ends.take(other) >> PLAIN_BITS
        ids[at], low[at] = other, begin + taken
        size[at] = (w0 * self.ends.take(other + 1) >> PLAIN_BITS) - begin
        return ids, low, size

    def _at(self, shares: np.ndarray) -> np.ndarray:
        """The ids at places of order 0; the guide counts the ids that start before a slot."""
        if self.guide is None:
            starts = np.bincount((self.ends[:-1] >> SLOT_BITS) + 1, minlength=2)
            self.guide = np.zeros((1 << PLAIN_BITS - SLOT_BITS) + 1, np.int64)
            np.cumsum(starts, out=self.guide[: len(starts)])
            self.guide[len(starts) :] = self.symbols
        # Every id has a place, so no more ids start in a slot than it has places.
        found = self.guide.take(shares >> SLOT_BITS)
        for step in (*(1 << bit for bit in reversed(range(SLOT_BITS))), 1):
            found += step * (self.ends.take(found + step - 1, mode="clip") <= shares)
        return found - 1

    def learn(self, ids: np.ndarray) -> None:
        n = len(ids)
        hit1, hit2 = self.p1 == ids, self.p2 == ids
        outcome = self.case * 2 + hit2
        outcome = outcome * 2 + hit1
        self.cases += np.bincount(outcome, minlength=self.cases.size).reshape(-1, 4)
        if self.steps % REFRESH == 0:
            old = self.cases.sum(axis=1) > AGED
            self.cases[old] = (self.cases[old] + 1) >> 1
        fresh = ids << SURE_BITS | 1
        for table, at, held, sure, hit in (
            (self.one, self.last[:n], self.held1, self.s1, hit1),
            (self.two, self.at2, self.held2, self.s2, hit2),
        ):
            kept = held + _CHANGE.take(sure * 2 + hit)
            table[at] = np.where(hit | (sure > 1), kept, fresh).astype(np.int32)
        self.before[:n] = self.last[:n]
        self.last[:n] = ids
        self.news.append(ids)
        self.steps += 1
        if self.steps & (self.steps - 1) == 0 or self.steps % REFRESH == 0:
            self._sum()


    def rest_odds(self) -> int:
        """How probable it is that an id ends as the last id of its symbol did."""
        return 1 + ((1 << REST_BITS) - 2) * self.same // self.rests

    def learn_rest(self, symbol: np.ndarray, rest: np.ndarray, same: np.ndarray) -> None:
        self.rest[symbol] = rest
        self.same += int(same.sum())
        self.rests += len(same)


def _layout(n: int, vocabulary: int) -> tuple[int, int, int, int]:
    """Lanes, steps, symbols and bits after the symbol's of a block of ``n`` ids."""
    bits = max(1, int(vocabulary - 1).bit_length())
    if bits > 31:
        raise ValueError("ids of more than 31 bits are not supported")
    steps = min(STEPS, 1 << n.bit_length() // 2)
    flat = max(0, bits - SYMBOL_BITS)
    return -(-n // steps), steps, (vocabulary - 1 >> flat) + 1, flat


def encode(blocks: list[np.ndarray], vocabulary: int) -> list[bytes]:
    """Payload of each block: crc32 of its ids, words of each lane, then the lanes' words."""
    return [_encode(np.asarray(block), vocabulary) for block in blocks]


def _encode(block: np.ndarray, vocabulary: int) -> bytes:
    check = zlib.crc32(block.astype("<u4").tobytes()).to_bytes(4, "little")
    lanes, steps, symbols, flat = _layout(len(block), vocabulary)
    if not lanes:
        return check
    grid = np.zeros(lanes * steps, np.int32)
    grid[: len(block)] = block
    grid = np.ascontiguousarray(grid.reshape(lanes, steps).T)
    short = len(block) - (lanes - 1) * steps  # ids of the last lane
    model = _Model(lanes, symbols)
    words = np.zeros((lanes, steps * (3 if flat else 1) + 1), np.uint32)
    used = np.zeros(lanes, np.int64)
    every = np.arange(lanes)
    low = np.zeros(lanes, np.uint64)
    span = np.full(lanes, 0xFFFFFFFFFFFFFFFF, np.uint64)

    def put(lane, start, size, bits):
        part = span[lane] >> np.uint64(bits)
        low[lane] += part * start.astype(np.uint64)
        part *= size.astype(np.uint64)
        span[lane] = part
        at = _short(part, lane)
        words[at, used[at]] = _settle(low, span, at)
        used[at] += 1

    for step in range(steps):
        n = lanes if step < short else lanes - 1
        if not n:
            break
        ids = grid[step, :n].astype(np.int64)
        symbol = ids >> flat
        model.look(n)
        put(slice(n), *model.place(symbol), TOTAL_BITS)
        if flat:
            rest = ids & ((1 << flat) - 1)
            same, odds = model.rest[symbol] == rest, model.rest_odds()
            put(slice(n), np.where(same, 0, odds), np.where(same, odds, (1 << REST_BITS) - odds), REST_BITS)
            put(every[:n][~same], rest[~same], np.ones((~same).sum(), np.int64), flat)
            model.learn_rest(symbol, rest, same)
        model.learn(symbol)
    # A word that lies in the lane's span whatever is read after it.
    words[every, used] = ((low >> _HALF) + ((low & _LOW) > 0)).astype(np.uint32)
    used += 1
    kept = np.arange(words.shape[1]) < used[:, None]
    return check + used.astype("<u2").tobytes() + words[kept].astype("<u4").tobytes()


def _short(span: np.ndarray, lane: slice | np.ndarray) -> np.ndarray:
    """Lanes, of those given, whose span asks for another word."""
    at = np.flatnonzero(span <= _LOW)
    return at if isinstance(lane, slice) else lane[at]


def _settle(low: np.ndarray, span: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Leading words of the lanes, which leave them; a span across two such words is cut."""
    lows, spans = low[at], span[at]
    across = (lows ^ (lows + spans - np.uint64(1))) > _LOW
    spans = np.where(across, -lows & _LOW, spans)
    low[at], span[at] = lows << _HALF, spans << _HALF
    return (lows >> _HALF).astype(np.uint32)


def decode(payloads: list[bytes], lengths: list[int], vocabulary: int) -> list[np.ndarray]:
    """Ids of each block; a block whose checksum differs raises ValueError."""
    return [_decode(p, int(n), vocabulary) for p, n in zip(payloads, lengths)]


def _decode(payload: bytes, length: int, vocabulary: int) -> np.ndarray:
    lanes, steps, symbols, flat = _layout(length, vocabulary)
    used = np.frombuffer(payload[4 : 4 + 2 * lanes], "<u2").astype(np.int64)
    if len(used) != lanes or len(payload) != 4 + 2 * lanes + 4 * int(used.sum()):
        raise ValueError("a block of token ids is damaged")
    words = np.frombuffer(payload[4 + 2 * lanes :], "<u4").astype(np.uint64)
    at_word = np.cumsum(used) - used
    ends = np.cumsum(used)
    grid = np.zeros((steps, lanes), np.uint32)
    short = length - (lanes - 1) * steps
    model = _Model(lanes, symbols)
    low = np.zeros(lanes, np.uint64)
    span = np.full(lanes, 0xFFFFFFFFFFFFFFFF, np.uint64)
    code = np.zeros(lanes, np.uint64)

    def read(lane):
        """Next word of each lane; nothing but zeros after the last."""
        at = at_word[lane]
        found = np.where(at < ends[lane], words[np.minimum(at, len(words) - 1)], np.uint64(0))
        at_word[lane] = at + 1
        code[lane] = code[lane] << _HALF | found

    def place(lane, bits):
        part = span[lane] >> np.uint64(bits)
        found = (code[lane] - low[lane]) // part
        return part, np.minimum(found, np.uint64((1 << bits) - 1)).astype(np.int64)

    def take(lane, part, start, size):
        low[lane] += part * start.astype(np.uint64)
        part = part * size.astype(np.uint64)
        span[lane] = part
        at = _short(part, lane)
        _settle(low, span, at)
        read(at)

    every = np.arange(lanes)
    if lanes:
        read(every)
        read(every)
    for step in range(steps):
        n = lanes if step < short else lanes - 1
        if n < 1:
            break
        model.look(n)
        part, places = place(slice(n), TOTAL_BITS)
        symbol, start, size = model.found(places)
        take(slice(n), part, start, size)
        ids = symbol
        if flat:
            part, places = place(slice(n), REST_BITS)
            odds, rest = model.rest_odds(), model.rest[symbol]
            same = places < odds
            take(slice(n), part, np.where(same, 0, odds), np.where(same, odds, (1 << REST_BITS) - odds))
            other = every[:n][~same]
            part, rest[other] = place(other, flat)
            take(other, part, rest[other], np.ones(len(other), np.int64))
            model.learn_rest(symbol, rest, same)
            ids = symbol << flat | rest
        grid[step, :n] = ids
        model.learn(symbol)
    found = np.ascontiguousarray(grid.T).reshape(-1)[:length].astype("<u4", copy=False)
    if zlib.crc32(found.tobytes()) != int.from_bytes(payload[:4], "little"):
        raise ValueError("a block of token ids is damaged")
    return found
