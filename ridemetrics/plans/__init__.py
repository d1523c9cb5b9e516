from ridemetrics.plans.questions import QUESTIONS, answers, prepare

__all__ = ["QUESTIONS", "answers", "prepare"]
