"""Fixed values.

These must equal the values the survey processing has always produced, so that
downstream consumers of the deliverable tables see the same codes and labels.
They are stated here once, as text, in their natural order.
"""

# --- fixed values: domain spacing -------------------------------------------------
STATION_SPACING_M = 5       # laser stations every 5 m
REPORT_INTERVAL_M = 25      # reporting grid / survey points every 25 m
PAVE_SPACING_M = 3          # pavement images every 3 m
NEAR_DISTANCE_DEG = 0.00004  # planar distance for "same place" tests, degrees
GAP_MARGIN_M = 6            # gap window margin for laser stations
PAVE_GAP_MARGIN_M = 3       # gap window margin for pavement images
EVENT_NEIGHBOUR_M = 5       # neighbour stations around an event position
STATUS_TOLERANCE_M = 5      # key range widening for the GPS-loss status count
MAX_LOST_GRID_STATIONS = 10  # more lost grid stations than this -> do not proceed
IRI_LIMIT = 8               # IRI above this is replaced by a draw in [7, 8]
IRI_DRAW_LOW = 7

# --- fixed values: key-code event type -------------------------------------------
PAVE_EVENT_TYPE = "pavetype."
CONSTRUCTION_LINK = "construction"

# --- fixed values: GPS-loss status labels (Thai, as stored in the tables) ----------
STATUS_LOST = "มีGPSlost"
STATUS_NOT_LOST = "ไม่มีGPSlost"
STATUS_PROCEED = "ดำเนินการต่อ"
STATUS_DO_NOT_PROCEED = "***ไม่ดำเนินการต่อ"

# --- fixed values: ramp-id check labels --------------------------------------------
RAMP_OK = "ถูกแล้ว"
RAMP_MISSING = "ลืมกรอก ramp_id"

# --- fixed values: link/lane consistency messages, in rule order -------------------
LANE_MSG_L_SIDE = "Link_id ระบุฝั่ง L ผิด ตรวจสอบ Link_id และ lane_no"
LANE_MSG_R_SIDE = "Link_id ระบุฝั่ง R ผิด ตรวจสอบ Link_id และ lane_no"
LANE_MSG_NO_LANE = "Link_id ระบุผิดไม่ระบุทางหลัก ตรวจสอบ Link_id และ lane_no"
LANE_MSG_F = "Link_id ระบุฝั่งประเภททางขนานผิด ตรวจสอบ Link_id และ lane_no"
LANE_MSG_I = "Link_id ระบุฝั่งประเภททาง Interchange ผิด ตรวจสอบ Link_id และ lane_no"
LANE_MSG_U = "Link_id ระบุฝั่งประเภททาง U-Trun ผิด ตรวจสอบ Link_id และ lane_no"
LANE_MSG_B = "Link_id ระบุฝั่งประเภททางสะพานผิด ตรวจสอบ Link_id และ lane_no"
LANE_MSG_T = "Link_id ระบุฝั่งประเภททางอุโมงค์ผิด ตรวจสอบ Link_id และ lane_no"
# lane_no first letter -> expected |lane_group|
LANE_LETTER_GROUP = [("F", 2, LANE_MSG_F), ("I", 3, LANE_MSG_I), ("U", 4, LANE_MSG_U),
                     ("B", 5, LANE_MSG_B), ("T", 6, LANE_MSG_T)]

# --- fixed values: lane-group range (report knows 1..6, survey table 1..7) ---------
REPORT_MAX_LANE_GROUP = 6
SURVEY_MAX_LANE_GROUP = 7

# --- fixed values: survey-type codes by surface ------------------------------------
SURFACE_AC = "AC"   # -> survey_type 2
SURFACE_CC = "CC"   # -> survey_type 1

# --- fixed values: deliverable literals ---------------------------------------------
SURVEY_REMARK = "CU_survey"
SURVEY_RUN_NEW_FOLDER = "BTS22"
SURVEY_RUN_NEW = "S22"
IMAGE_DIR_PREFIX = "s22/cu_survey/"
IMAGE_ROW_TAG = "-ROW-0-"
IMAGE_PATH_FLAG = "True"
IMAGE_REMARK = "CU_S22"
PAVE_DIR_PREFIX = "cu_survey/"
PAVE_TAG = "-PAVE-0-"
PAVE_PATH_FLAG = "true"
PAVE_REMARK = "cu_survey"
IMAGE_EXT = ".jpg"
# duplicate image repair: last frame digit 0 -> 3, 5 -> 7
IMAGE_RENAME_DIGITS = {0: "3", 5: "7"}
# image folder manifests (copy scripts)
ROW_TARGET_ROOT = "E:\\s22\\row\\image\\"
PAVE_TARGET_ROOT = "E:\\s22\\pave\\image\\"
SOURCE_ROOT = "E:\\"
