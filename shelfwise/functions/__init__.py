from shelfwise.functions.common import RANK_DIGITS, SCORE_DIGITS, score, shown

__all__ = ["RANK_DIGITS", "SCORE_DIGITS", "score", "shown"]
