"""Values that other programs, files and saved results depend on."""

# Map colours (r, g, b) per land-use class.
PALETTE = {
    "Barren": (0, 255, 0),
    "Cultivated": (255, 255, 255),
    "Developed": (255, 0, 0),
    "Forest": (0, 255, 0),
    "Herbaceous": (0, 255, 0),
    "Shrub": (0, 255, 0),
}
BLACK = (0, 0, 0)

# Pretrained networks and the node whose output is the feature vector.
FEATURE_LAYER = {"resnet18": "z.x", "alexnet": "h2_d"}

# Classifier settings.
RANDOM_FOREST = {"numTrees": 20, "maxDepth": 5}
LOGISTIC_REGRESSION = {"regParam": 0.01, "maxIter": 10}
LAST_LAYER_L2 = 0.0005
DEFAULT_EPOCHS = 10

# Step training. Rates per row, each up to an epoch, and the rows over which momentum fades.
ROW_RATES = ((0.00001, 33), (0.000001, 66), (0.0000001, None))
MOMENTUM_ROWS = 10

# Network input and training-time augmentation.
TILE_SIDE = 224
PIXEL_MEAN = 114.0
CROP_RATIO = 0.85
COLOUR_RADIUS = 0.2

# Retraining depths and classifier names accepted as arguments.
RETRAINING_TYPES = ("last_only", "fully_connected", "all")
CLASSIFIER_TYPES = ("randomforest", "logisticregression")

# Fields of a model card, in file order, and the two model sources: names of this suite.
CARD_FIELDS = (
    "output_model_name",
    "model_source",
    "pretrained_model_type",
    "retraining_type",
    "classifier_type",
)
SOURCE_CLASSIFIER = "classifier"
SOURCE_NETWORK = "dnn"

# The two line shapes of a training log. The epoch line exists in two
# spellings, with and without a blank after the opening bracket.
EPOCH_LINE = (
    r"^Finished Epoch\[(\d+) of \d+\]: \[Training\] loss = ([0-9.]+) \* [0-9]+, "
    r"metric = ([0-9.]+)% \* [0-9]+ ([0-9.]+)s \( ?([0-9.]+) samples/s\);"
)
ACCURACY_LINE = r"^Overall accuracy on test set: ([0-9.]+)"
