"""Schemas of the feature tables."""

from __future__ import annotations

FRAMES = "video_id string, frame_idx bigint, height int, width int, rgb binary"
SELECTED = "video_id string, row_pos bigint, frame_idx bigint"
BLOCKS = "video_id string, block_id int, read_start bigint, read_end bigint, write_start bigint"
DINO = "video_id string, camera_key string, frame_idx bigint, token_idx int, vec array<float>"
DEPTH = "video_id string, camera_key string, frame_idx bigint, height int, width int, px array<int>"
POSE = "video_id string, frame_idx bigint, pose array<float>"
COMPLETION = "video_id string, branch string, complete boolean, attempt bigint"
CHECKS = "branch string, name string, expected string, observed string, passed boolean"
PERF = "video_id string, branch string, frames bigint, seconds double, fps double, peak_mem_mb double, note string"
BRANCH_META = "video_id string, branch string, camera_key string, representation string, scale double, pose_dim int, shape array<bigint>, patch_grid struct<h:int,w:int>, has_cls_token boolean"
ANNOTATION = "video_id string, video_path string, fps double, num_frames bigint, has_state boolean, has_action boolean, has_weak_action boolean, has_strong_action boolean, has_depth boolean, has_pose boolean, state_dim int, action_dim int, state array<double>, action array<double>, source string"

#: Branches of features, in the order in which they are made and preferred.
BRANCHES = ("dino", "depth", "pose")
