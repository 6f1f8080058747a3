"""Fixed values of the data format and of the scoring."""

#: radiometry: degrees Celsius = DN * GAIN - OFFSET
GAIN = 0.04
OFFSET = 273.15
HOT_CELSIUS = 80.0
HOT_DN = 8829
SATURATION_DN = 11568
PERCENTILES = (0.1, 1.0, 5.0, 25.0, 50.0, 75.0, 95.0, 99.0, 99.9)

#: thermal frames
HEIGHT, WIDTH, BITS = 512, 640, 16
DTYPE, MAKE, MODEL, NORMALIZED = "uint16", "FLIR", "Vue Pro R 640 13mm", 1
#: video
FPS, VIDEO_WIDTH, VIDEO_HEIGHT = 30.0, 3840, 2160

#: pad geometry: widths of the Gaussian scores, weights and hard limits
CENTER_WIDTH, RADIUS_WIDTH, ANISOTROPY_WIDTH = 0.075, 0.12, 0.18
GEOMETRY_WEIGHTS = {"center": 0.48, "radius": 0.28, "ring": 0.16, "anisotropy": 0.08}
CENTER_LIMIT, RADIUS_LIMIT, ANISOTROPY_LIMIT = 0.12, 0.18, 0.25
#: composite of geometry, masked and full visual similarity; factor without hard pass
COMPOSITE_WEIGHTS = {"geometry": 0.65, "masked": 0.25, "full": 0.10}
NO_PASS_FACTOR = 0.25
#: tracking
HIGH_CONFIDENCE = 0.72
MOST_CROPS = 20

#: guided crops
SIZE_SCALES = (0.92, 0.97, 1.0, 1.03, 1.08)
ASPECT_SCALES = (0.98, 1.0, 1.02)
CENTER_SHIFTS = (-0.12, 0.0, 0.12)

#: path fields of a manifest and their file of a sample
MANIFEST_PATHS = {"thermal_tiff_path": "thermal.tiff", "thermal_png_path": "thermal.png", "video_png_path": "video.png", "overlay_png_path": "overlay.png", "mask_80c_path": "mask_80c.png"}
#: file names of a viewer row and the manifest's path field they come from
VIEWER_FILES = {"thermal_file_name": "thermal_png_path", "thermal_tiff_file_name": "thermal_tiff_path", "rgb_file_name": "video_png_path", "overlay_file_name": "overlay_png_path", "mask_80c_file_name": "mask_80c_path"}
VIEWER_TEXTS = ("sequence_id", "aligned_id", "tiff_time_iso", "video_time", "thermal_tiff_path", "thermal_source_path")
VIEWER_NUMBERS = {"video_time_s": "double", "video_frame_index": "bigint", "visual_score": "double", "mask_positive_pixels": "bigint", "mask_positive_fraction": "double"}
VIEWER_FIELDS = ("sequence_id", "aligned_id", *VIEWER_FILES, "tiff_time_iso", "video_time", *VIEWER_NUMBERS, "thermal_tiff_path", "thermal_source_path")
SAMPLE_FILES = ("thermal.tiff", "thermal.png", "video.png", "overlay.png", "mask_80c.png")

#: scores of thermal circles: prior's centre and width, weights, and factors
#: for large circles
RADIUS_PRIOR = (0.17, 0.11)
THERMAL_WEIGHTS = {"support": 0.35, "coverage": 0.30, "prominence": 0.15, "contrast": 0.10, "prior": 0.07, "border": 0.03}
LARGE_RADIUS, LARGE_FACTOR = 0.30, 0.65
FLAT_RADIUS, FLAT_PROMINENCE, FLAT_FACTOR = 0.24, 0.03, 0.85
#: scores of contour circles: share of the shorter side, weights, usual fill of whole and partial circles, bonus of an arc
CONTOUR_SIDE = 0.18
CONTOUR_WEIGHTS = {"size": 0.30, "circularity": 0.25, "support": 0.25, "area": 0.20}
CONTOUR_FILL, PARTIAL_FILL, ARC_BONUS = 0.58, 0.30, 0.08
#: confidence of Hough circles: base, and (weight, full value) of support and fill; partial circles lose
HOUGH_BASE, HOUGH_SUPPORT, HOUGH_FILL, HOUGH_PARTIAL = 0.78, (0.12, 0.22), (0.08, 0.35), 0.12
#: tracking: cost weights, least radius of a scale, gates of a seed, and gates that widen by the frame up to a limit
COST_WEIGHTS = {"center": 2.8, "radius": 1.8, "doubt": 0.7, "no_hough": 0.35, "partial": 0.30}
LEAST_SCALE, LEAST_PREDICTED = 24.0, 20.0
SEED_CENTER, SEED_RATIO = 0.55, 1.55
CENTER_GATE, CENTER_STEP, CENTER_MOST = 0.90, 0.12, 2.4
RATIO_GATE, RATIO_STEP, RATIO_MOST = 1.48, 0.025, 2.2
