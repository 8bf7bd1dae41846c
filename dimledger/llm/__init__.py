"""Training-data operators. Each module holds one operator, its registered
query and, where SQL can express it, its oracle SQL; ``registry`` gathers them.
Nothing else in the package imports this subpackage.
"""
