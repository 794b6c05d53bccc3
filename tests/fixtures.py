"""Golden gaming rows (FIXTURES.md section 1) and small helpers for tests."""

import datetime as dt

from tidemark import schemas as S

BASE = dt.datetime(2022, 2, 2)

# The 12 golden events (seq, nickname, type, seconds after BASE).
GOLDEN = [
    (0, "bob", S.PLAYER_REGISTERED, 2), (1, "bob", S.PLAYER_ONLINE, 2),
    (2, "sam", S.PLAYER_REGISTERED, 3), (3, "sam", S.PLAYER_ONLINE, 4),
    (4, "rob", S.PLAYER_REGISTERED, 4), (5, "alice", S.PLAYER_REGISTERED, 4),
    (6, "mary", S.PLAYER_REGISTERED, 6), (7, "mary", S.PLAYER_ONLINE, 6),
    (8, "carl", S.PLAYER_REGISTERED, 8), (9, "rob", S.PLAYER_ONLINE, 10),
    (10, "alice", S.PLAYER_ONLINE, 10), (11, "carl", S.PLAYER_ONLINE, 10),
]


def golden_df(spark):
    rows = [(seq, et, f"player-{nick}", nick, BASE + dt.timedelta(seconds=sec), None, None, None, None, None)
            for seq, nick, et, sec in GOLDEN]
    return spark.createDataFrame(rows, S.SERVER_EVENTS)


def sec(t):
    return int((t - BASE).total_seconds())
