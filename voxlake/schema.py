"""Fixed schemas of the library's tables; ids are always strings, never inferred."""

from __future__ import annotations

FOLD_VOXELS = "subject_id string, side string, sulcus string, vertex_id bigint, bucket string, i int, j int, k int"
SUBJECT_SPACE = "subject_id string, side string, voxel_size array<double>, affine array<double>"
MASK_VOXELS = "mask_set string, side string, sulcus string, x int, y int, z int, n int"
CROP_VOXELS = "region string, side string, input_type string, subject_id string, x int, y int, z int, value float"
CROP_TENSOR = "region string, side string, input_type string, row_idx int, subject_id string, shape array<int>, values array<float>"
EMBEDDINGS = "run string, region string, hemi string, model_id string, subject_id string, vec array<float>"
QC = "participant_id string, qc int, comments string"
NOMENCLATURE = "brain map<string,map<string,array<string>>>"
PROJECTION_COORDS = "region string, hemi string, subject_id string, u double, v double"
PROJECTION_MODEL = "region string, hemi string, mean array<double>, axes array<array<double>>"
