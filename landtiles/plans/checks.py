"""Argument checks shared by the jobs."""

from landtiles.fixed import CLASSIFIER_TYPES, FEATURE_LAYER, RETRAINING_TYPES

SOLVERS = ("full", "steps")


def check_fraction(fraction: float) -> None:
    if not 0.0 < fraction <= 1.0:
        raise ValueError("sampling fraction must be above 0.0 and at most 1.0")


def check_pretrained(kind: str) -> None:
    _one_of("pretrained model type", kind, tuple(FEATURE_LAYER))


def check_classifier(kind: str) -> None:
    _one_of("classifier type", kind, CLASSIFIER_TYPES)


def check_retraining(pretrained: str, depth: str, epochs: int) -> None:
    check_pretrained(pretrained)
    _one_of("retraining type", depth, RETRAINING_TYPES)
    if epochs <= 0:
        raise ValueError("number of epochs must be greater than zero")
    if pretrained == "resnet18" and depth == "fully_connected":
        raise ValueError("resnet18 has no fully connected part to retrain")
    if depth == "all":
        raise ValueError("retraining the convolution layers is not supported")


def check_solver(solver: str, step_rows: int) -> None:
    _one_of("solver", solver, SOLVERS)
    if step_rows <= 0:
        raise ValueError("number of rows of a step must be greater than zero")


def _one_of(what: str, value: str, allowed: tuple[str, ...]) -> None:
    if value not in allowed:
        raise ValueError(f"{what} must be one of {', '.join(allowed)}")
